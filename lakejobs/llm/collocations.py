"""Phrase collocations from a weighted de Bruijn graph of words.

Edges are the longest grams (four words), counted once for every place of a piece;
nodes are the three words two edges share. A place near the end of its piece gives
a shorter record, the piece-end correction: with it the count of a shorter phrase
is the flow out of its node. Paths of nodes with one way in and one way out carry
one weight and are compacted, so long repeated passages are a row each.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import stored

UPPER = re.compile("[A-Z]+")
BREAK = re.compile(r"[.,;:!?\x0A-\x0D]+")
WORD = re.compile(r"[^\x20\x09]+")
#: Words of an edge.
SIZE = 4
#: Places and characters that a task counts at a time, and characters above which a text is read in runs of pieces.
PLACES, CHARACTERS, LONG_TEXT = 2_000_000, 64_000_000, 4_000_000
#: Edges of a batch that a task hands on, and the first number of the shares of a frequent pair.
ROWS, PARTS = 65_536, 1 << 20
#: Bytes of text whose edges one task sums, and bytes of the sample that finds very frequent word pairs.
TASK_BYTES, SAMPLE_BYTES = 8 << 20, 32 << 20
#: A word or a pair of words with this share of the sampled edges is spread over tasks.
HOT_SHARE = 1 / 1024


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else UPPER.sub(lambda m: m.group().lower(), text)


def _words(text: str) -> Iterator[str]:
    if len(text) > LONG_TEXT:
        return (m.group() for m in WORD.finditer(text))
    return filter(None, text.replace("\t", " ").split(" "))


class _Places:
    """Word numbers of the pieces read so far; a zero ends a piece."""

    def __init__(self, hot: Hot) -> None:
        self.hot = hot
        # A new word gets the next number; a line end stands for the end of a piece.
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.known["\n"]
        self.langs: dict[str, int] = {}
        self.held: list[np.ndarray] = []
        self.lang: list[tuple[int, int]] = []
        self.size = self.characters = 0

    def add(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        lowered = _lowered(text)
        if len(lowered) <= LONG_TEXT:
            self._keep(lang, self._numbers(_words(BREAK.sub(" \n ", lowered))))
        else:
            at = 0
            for end in BREAK.finditer(lowered):
                # Runs of whole pieces, so that few words of a very long text are held at a time.
                if end.start() - at > LONG_TEXT // 8:
                    self._keep(lang, self._numbers(_words(BREAK.sub(" \n ", lowered[at:end.start()]))))
                    at = end.end()
                    if self.size >= PLACES:
                        yield from self.flush()
            self._keep(lang, self._numbers(_words(BREAK.sub(" \n ", lowered[at:]))))
        self.characters += len(text)
        if self.size >= PLACES or self.characters >= CHARACTERS:
            yield from self.flush()

    def _numbers(self, words: Iterator[str]) -> np.ndarray:
        return np.append(np.fromiter(map(self.known.__getitem__, words), np.int32), np.int32(0))

    def _keep(self, lang: str, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.lang.append((self.langs.setdefault(lang, len(self.langs)), len(ids)))
        self.size += len(ids)

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Rows (head, salt, tails) of the places read so far, which are forgotten then."""
        if not self.held:
            return
        flat = np.concatenate([*self.held, np.zeros(SIZE - 1, np.int32)])
        lang = np.repeat(np.array([x for x, _ in self.lang], np.int32), [n for _, n in self.lang])
        names, langs, hot = ["", *list(self.known)[1:]], list(self.langs), self.hot
        words, wide = pa.array(names, pa.string()), np.int64(len(names))
        self.__init__(hot)
        here = np.flatnonzero(flat[:len(lang)]).astype(np.int32)
        lang = lang[here]
        yield _rows(pa.array([f"{x}\t" for x in langs], pa.string()), np.zeros(len(langs)), _texts(np.bincount(lang, minlength=len(langs))))
        # Numbers of 32 bits and few arrays at a time: two such tasks share an executor with its heap.
        heads, head = _numbered(lang * wide + flat[here])
        del lang
        begin = pc.binary_join_element_wise(pa.array(langs, pa.string()).take(pa.array(heads // wide)), words.take(pa.array(heads % wide)), "\t")
        yield _rows(begin, np.zeros(len(heads)), _texts(np.bincount(head)))
        # A last word alone begins no pair: only the words count it.
        pair = flat[here + 1] > 0
        here, head = here[pair], head[pair]
        pairs, pair = _numbered(head * wide + flat[here + 1])
        del head
        ends, end = _numbered(flat[here + 2] * wide + np.where(flat[here + 2] == 0, 0, flat[here + 3]))
        del here, flat
        grams = pair * np.int64(len(ends)) + end
        del pair, end
        grams.sort()
        at = np.flatnonzero(_changes(grams))
        counts, grams = np.diff(at, append=len(grams)).astype(np.int32), grams[at]
        pair, end = (grams // max(len(ends), 1)).astype(np.int32), (grams % max(len(ends), 1)).astype(np.int32)
        del grams, at
        third, fourth = (ends // wide).astype(np.int32)[end], (ends % wide).astype(np.int32)[end]
        del end, ends
        salt = hot.salts(begin, names, pairs, pair, third, fourth)
        head, second = (pairs // wide).astype(np.int32)[pair], (pairs % wide).astype(np.int32)[pair]
        del pair, pairs
        if salt.any():
            order = np.lexsort((salt, head))
            head, salt = head[order], salt[order]
            second, third = second[order], third[order]
            fourth, counts = fourth[order], counts[order]
            del order
        starts = np.flatnonzero(_changes(head) | _changes(salt))
        starts = np.append(starts, len(head))
        at = 0
        while at < len(starts) - 1:
            # Whole heads with at least ROWS edges together, so that few strings are held at a time.
            until = min(max(at + 1, int(np.searchsorted(starts, starts[at] + ROWS))), len(starts) - 1)
            lo, hi = starts[at], starts[until]
            texts = pc.binary_join_element_wise(*(words.take(pa.array(x[lo:hi])) for x in (second, third, fourth)), _texts(counts[lo:hi]), " ")
            lists = pa.ListArray.from_arrays(pa.array((starts[at:until + 1] - lo).astype(np.int32)), texts)
            yield _rows(begin.take(pa.array(head[starts[at:until]])), salt[starts[at:until]], pc.binary_join(lists, "\t"))
            at = until


@dataclass(frozen=True)
class Hot:
    """Words and pairs (``lang\\tword``, ``lang\\tword word``) whose edges are dealt to several tasks, and to how many."""

    words: dict[str, int] = field(default_factory=dict)
    pairs: dict[str, int] = field(default_factory=dict)

    def salts(self, begin: pa.Array, names: list[str], pairs: np.ndarray, pair: np.ndarray, third: np.ndarray, fourth: np.ndarray) -> np.ndarray:
        """Share of each edge: 0, or one of its first word by the second, or from ``PARTS`` on one of its pair by the further words.

        ``pairs`` holds, in order, the number of a pair's first word in ``begin`` times the number of ``names``, plus that of its second word.
        """
        if not self.words and not self.pairs:
            return np.zeros(len(pair), np.int32)
        heads, wide = begin.to_pylist(), len(names)
        mark = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in names], np.int64)
        spread = np.array([self.words.get(h, 0) for h in heads], np.int64)[pairs // wide]
        salt = np.where(spread > 0, 1 + mark[pairs % wide] % np.maximum(spread, 1), 0).astype(np.int32)[pair]
        # Only the few frequent pairs are looked for, by their words; a second word has no blank.
        often = {tuple(p.rsplit(" ", 1)): n for p, n in self.pairs.items()}
        first, second = {h for h, _ in often}, {w for _, w in often}
        head_at, word_at = {h: i for i, h in enumerate(heads) if h in first}, {w: i for i, w in enumerate(names) if w in second}
        for (h, w), parts in often.items():
            key = head_at[h] * wide + word_at[w] if h in head_at and w in word_at else -1
            if (i := int(np.searchsorted(pairs, key))) < len(pairs) and pairs[i] == key:
                # Edges are in the order of their pairs.
                lo, hi = np.searchsorted(pair, [i, i + 1])
                salt[lo:hi] = PARTS + (mark[third[lo:hi]] * 31 + mark[fourth[lo:hi]]) % parts
        return salt


def _changes(keys: np.ndarray) -> np.ndarray:
    """Whether each of the keys differs from the one before it."""
    return np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the number of each key among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = _changes(keys)
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys[new], number


def _texts(counts: np.ndarray) -> pa.Array:
    return pc.cast(pa.array(counts.astype(np.int64)), pa.string())


def _rows(head: pa.Array, salt: np.ndarray, tails: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([head, pa.array(salt.astype(np.int32)), tails], names=["head", "salt", "tails"])


def places(docs: DataFrame, lang: str = "lang", text: str = "text", hot: Hot = Hot()) -> DataFrame:
    """(head, salt, tails) of all places, summed within each task.

    ``head`` is the language, a tab, and the first word of an edge; ``tails`` are its
    further words with their counts, ``second third fourth count`` between tabs, so that
    a first word is written once. An empty third or fourth word says that the piece
    ended there. A tail that is a number is the count of the word, or without a word of the language.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Places(hot)
        for batch in batches:
            for name, whole in zip(batch.column(0), batch.column(1)):
                yield from kept.add(name.as_py(), whole.as_py())
        yield from kept.flush()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "head string, salt int, tails string")


def hot_places(docs: DataFrame, lang: str, text: str, total: int) -> Hot:
    """Words and word pairs so frequent in a bounded sample that one task should not sum them; at most ``1 / HOT_SHARE`` of each.

    Only the dealing of records depends on them, not a count.
    """
    share = min(1.0, SAMPLE_BYTES / max(1, total))
    tails = places(docs.sample(share, seed=11), lang, text).select("head", F.explode(F.split("tails", "\t")).alias("tail")).where(F.contains("tail", F.lit(" ")))
    pairs = stored(tails.groupBy("head", F.substring_index("tail", " ", 1).alias("second")).agg(F.count(F.lit(1)).alias("edges")), "pairs")
    least = max(1000.0, (pairs.agg(F.sum("edges")).first()[0] or 0) * HOT_SHARE)
    spread = F.ceil(F.col("edges") * 4 / least).cast("int")
    words = pairs.groupBy("head").agg(F.sum("edges").alias("edges")).where(F.col("edges") > least).select("head", spread).collect()
    often = pairs.where(F.col("edges") > least).select(F.concat_ws(" ", "head", "second"), spread).collect()
    return Hot(dict(map(tuple, words)), dict(map(tuple, often)))


def counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30) -> DataFrame:
    """(lang, level, phrase, c): all phrases of 1 to 4 words with at least ``least`` occurrences, and the words of each language (level 0).

    Edges of one first word meet in one task, which sums edges, nodes and pairs
    together. Words that a sample finds very frequent are dealt by their second word,
    and so frequent pairs by their further words; only the sums of those are added up after.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    dealt = places(docs, lang, text, hot_places(docs, lang, text, total)).repartition(tasks, "head", "salt")
    each = dealt.select("head", "salt", F.explode(F.split("tails", "\t")).alias("tail")).select(
        "head", "salt", F.substring_index("tail", " ", 3).alias("rest"), F.substring_index("tail", " ", -1).cast("long").alias("c"))
    # The flow of an edge goes to its node and to the pair the node begins with; a piece that ended sooner gives to the shorter ones only.
    node, pair = F.substring_index("rest", " ", 2), F.substring_index("rest", " ", 1)
    flow = F.array(
        F.when(~F.endswith(F.col("rest"), F.lit(" ")), F.struct(F.lit(4).alias("level"), F.col("rest"))),
        F.when(~F.endswith(node, F.lit(" ")), F.struct(F.lit(3).alias("level"), node.alias("rest"))),
        F.struct(F.lit(2).alias("level"), pair.alias("rest")))
    own = F.array(F.struct(F.when(F.endswith(F.col("head"), F.lit("\t")), 0).otherwise(1).alias("level"), F.lit("").alias("rest")))
    given = each.select("head", "salt", "c", F.explode(F.when(F.contains("rest", F.lit(" ")), flow).otherwise(own)).alias("of")).where("of IS NOT NULL")
    summed = given.groupBy("head", "salt", "of.level", "of.rest").agg(F.sum("c").alias("c"))
    summed = stored(summed.where((F.col("salt") >= PARTS) | (F.col("c") >= least) | (F.col("level") == 0)), "sums")
    whole = summed.where(F.col("salt") < PARTS).select("head", "level", "rest", "c").unionByName(
        summed.where(F.col("salt") >= PARTS).groupBy("head", "level", "rest").agg(F.sum("c").alias("c")).where(F.col("c") >= least))
    first = F.substring_index("head", "\t", -1)
    phrase = F.when(F.col("rest") == "", first).otherwise(F.concat_ws(" ", first, "rest"))
    return stored(whole.select(
        F.expr("substring(head, 1, length(head) - length(substring_index(head, '\\t', -1)) - 1)").alias("lang"),
        "level", phrase.alias("phrase"), "c"), "counts")


def _part(words: Column | str, at: int, n: int) -> Column:
    return F.array_join(F.slice(words, at, n), " ")


def unary_paths(found: DataFrame) -> DataFrame:
    """(lang, words array, c): the edges of ``found``, with those joined that follow one another through nodes with one way in and out.

    An edge with the count of the node behind it is the only way into that node (and no piece begins there),
    one with the count of the node before it the only way out (and no piece ends there). Numbers in
    the path come by pointer doubling, written in each round; pieces end, so no such path is a ring.
    A path is at most as long as the longest piece, which one row holds.
    """
    node = found.where("level = 3").select("lang", F.col("phrase").alias("node"), F.col("c").alias("flow"))
    edge = found.where("level = 4").select("lang", F.split("phrase", " ").alias("words"), F.col("phrase").alias("edge"), "c")
    edge = edge.withColumn("from", _part("words", 1, 3)).withColumn("to", _part("words", 2, 3))
    only_in = edge.join(node.withColumnRenamed("node", "to"), ["lang", "to"]).where("c = flow").select("lang", F.col("to").alias("node"), F.col("edge").alias("before"))
    only_out = edge.join(node.withColumnRenamed("node", "from"), ["lang", "from"]).where("c = flow").select("lang", F.col("from").alias("node"), "edge")
    link = only_in.join(only_out, ["lang", "node"]).select("lang", "edge", "before")
    at = stored(edge.join(link, ["lang", "edge"], "left").select(
        "lang", "edge", "c", F.coalesce("before", "edge").alias("start"), F.when(F.col("before").isNull(), 0).otherwise(1).alias("place")), "paths")
    while not at.where("place > 0").isEmpty():
        ahead = at.select("lang", F.col("edge").alias("start"), F.col("start").alias("sooner"), F.col("place").alias("more"))
        moved = stored(at.join(ahead, ["lang", "start"]).select(
            "lang", "edge", "c", F.col("sooner").alias("start"), (F.col("place") + F.col("more")).alias("place"), "more"), "paths")
        at = moved.drop("more")
        if moved.where("more > 0").isEmpty():
            break
    ordered = F.array_sort(F.collect_list(F.struct("place", "edge")))
    path = at.groupBy("lang", "start", "c").agg(ordered.alias("edges"))
    later = F.transform(F.slice("edges", F.lit(2), F.size("edges")), lambda e: F.substring_index(e["edge"], " ", -1))
    return path.select("lang", F.concat(F.split("start", " "), later).alias("words"), "c")


def candidates(found: DataFrame, least: int = 30) -> DataFrame:
    """(lang, phrase, size, a, l, r, score): all phrases of 2 to 4 words with their weakest cut.

    Inside a compacted path the counts of both three-word parts are the weight of the
    path; other parts are looked up.
    """
    paths = stored(unary_paths(found), "unary")
    edges = paths.select("lang", "c", F.size("words").alias("n"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - (SIZE - 1))).alias("i"))
    edges = edges.select(
        "lang", F.expr(f"slice(words, i, {SIZE})").alias("words"), "c",
        (F.col("i") > 1).alias("from_path"), (F.col("i") < F.col("n") - (SIZE - 1)).alias("to_path"))
    short = found.where("level IN (2, 3)").select(
        "lang", F.split("phrase", " ").alias("words"), "c", F.lit(False).alias("from_path"), F.lit(False).alias("to_path"))
    every = edges.unionByName(short).select("*", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"))
    cut = every.select("lang", "phrase", "size", "c", "words", "from_path", "to_path", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left, right = F.expr("array_join(slice(words, 1, k), ' ')"), F.expr("array_join(slice(words, k + 1, size - k), ' ')")
    known_left = (F.col("size") == SIZE) & (F.col("k") == SIZE - 1) & F.col("from_path")
    known_right = (F.col("size") == SIZE) & (F.col("k") == 1) & F.col("to_path")
    sides = cut.select("lang", "phrase", "size", "c", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), left.alias("part"), known_left.alias("known")),
        F.struct(F.lit(1).alias("side"), right.alias("part"), known_right.alias("known")))).alias("s")).select("lang", "phrase", "size", "c", "k", "s.*")
    flow = found.where("level BETWEEN 1 AND 3").select("lang", F.col("phrase").alias("part"), F.col("c").alias("flow"))
    looked = sides.where("NOT known").join(flow, ["lang", "part"]).select("lang", "phrase", "size", "c", "k", "side", "flow").unionByName(
        sides.where("known").select("lang", "phrase", "size", "c", "k", "side", F.col("c").alias("flow")))
    both = looked.groupBy("lang", "phrase", "size", "c", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("flow"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("flow"))).alias("r"))
    # Decimals: the product of a count and two millions can pass 64 bits.
    score = F.expr("CAST(c AS DECIMAL(25,0)) * 2000000 DIV (CAST(l AS DECIMAL(25,0)) + r)").cast("long")
    weakest = both.withColumn("score", score).groupBy("lang", "phrase", "size", F.col("c").alias("a")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("w"))
    return weakest.select("lang", "phrase", "size", "a", "w.l", "w.r", "w.score")


def independent(scored: DataFrame, percent: int = 80) -> DataFrame:
    """``scored`` without phrases that lie inside a longer one with at least ``percent`` of their occurrences."""
    parts = lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - (n - 1)), lambda i: F.array_join(F.slice("words", i, n), " "))
    longer = scored.where("size > 2").withColumn("words", F.split("phrase", " ")).select(
        "lang", "a", F.explode(F.concat(parts(2), F.when(F.col("size") > 3, parts(3)).otherwise(F.array().cast("array<string>")))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return scored.join(most, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(25,0)") * 100 < F.col("a").cast("decimal(25,0)") * percent)).drop("longer")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, percent: int = 80, first: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and line ends, pieces
    into words at blanks and tabs. ``a``, ``l``, ``r`` are occurrences of the phrase and of
    both parts of its weakest cut, ``n`` the words of the language, ``score`` the floor of
    ``2000000 a / (l + r)``. Ranked by score and ``a``, largest first, then by the bytes of the phrase.
    A null language is ``und``; null, empty and blank texts have no words; repeated rows
    count again; an empty table gives no rows; other columns are not read.
    """
    found = counts(docs, lang, text, least)
    scored = stored(candidates(found, least), "candidates")
    left = independent(scored, percent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # Ranked within slices of a language first, so that the last task reads a fixed number of rows.
    slices = Window.partitionBy("lang", "slice").orderBy(*order)
    best = left.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(16))).withColumn(
        "rank", F.row_number().over(slices)).where(F.col("rank") <= first).drop("rank", "slice")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    words = found.where("level = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
