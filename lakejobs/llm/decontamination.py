"""Benchmark decontamination: a BM25 index of the test items, queried by every passage with block-max WAND.

Scores are shares: the BM25 mass of the item's words that a passage holds, over
the mass of all of them, so one threshold fits long and short items. Every passage
that reaches it is verified by the words of question and answer that it holds in runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_]+"
TOKENS = re.compile(r"\w+")
#: Words of a half passage; a passage is two neighbouring halves, so any item of that length lies in one whole.
HALF = 64
#: Items of a block: a block keeps the largest score each word has in it.
BLOCK = 4
#: Items broadcast at a time; with more of them the documents are read once for each slice.
SLICE_ITEMS = 1024
K1, B = 1.2, 0.75
#: Texts split into words at a time.
TEXTS = 512


@dataclass(frozen=True)
class Item:
    item_id: int
    question: tuple[str, ...]
    answer: tuple[str, ...]


@dataclass
class Index:
    """Postings of one slice of items: for each word the item numbers in order and their shares, and block maxima."""

    items: list[Item]
    words: dict[str, int]
    starts: np.ndarray
    posting_item: np.ndarray
    posting_share: np.ndarray
    block_max: np.ndarray
    shingle: int


def words_of(text: str | None) -> list[str]:
    return TOKENS.findall((text or "").lower())


def build_index(items: list[Item], frequency: dict[str, int], total: int, mean_length: float, shingle: int) -> Index:
    """Inverted index of a slice; document frequencies, number and mean length are those of all items."""
    postings: dict[str, list[tuple[int, float]]] = {}
    for no, item in enumerate(items):
        words = item.question + item.answer
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        part = {}
        for w, tf in counts.items():
            idf = np.log1p((total - frequency[w] + 0.5) / (frequency[w] + 0.5))
            part[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
        mass = sum(part.values()) * min(1.0, HALF / max(1, len(words)))
        for w, value in part.items():
            postings.setdefault(w, []).append((no, value / mass if mass else 0.0))
    terms = {w: i for i, w in enumerate(postings)}
    flat = [p for w in postings for p in postings[w]]
    starts = np.concatenate(([0], np.cumsum([len(v) for v in postings.values()]))).astype(np.int64)
    blocks = max(1, -(-len(items) // BLOCK))
    block_max = np.zeros((len(terms), blocks), dtype=np.float32)
    for t, plist in enumerate(postings.values()):
        for no, share in plist:
            block_max[t, no // BLOCK] = max(block_max[t, no // BLOCK], share)
    return Index(items, terms, starts, np.array([p[0] for p in flat], np.int64), np.array([p[1] for p in flat], np.float64), block_max, shingle)


def wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items whose score reaches ``threshold`` for a passage with these distinct words, by block-max WAND.

    Cursors stand in item order. The pivot is the first cursor at which the sum of
    the words' maxima can reach the threshold; if the block maxima at the pivot
    cannot, all cursors up to it jump behind the nearest block end.
    """
    cursors = []
    for t in terms:
        lo, hi = int(index.starts[t]), int(index.starts[t + 1])
        cursors.append([lo, hi, t, float(index.posting_share[lo:hi].max())])
    found = []
    items, shares = index.posting_item, index.posting_share
    slack = threshold - 1e-6
    while True:
        cursors = [c for c in cursors if c[0] < c[1]]
        cursors.sort(key=lambda c: items[c[0]])
        upper, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            upper += c[3]
            if upper >= slack:
                pivot = i
                break
        if pivot < 0:
            return found
        at = int(items[cursors[pivot][0]])
        while pivot + 1 < len(cursors) and items[cursors[pivot + 1][0]] == at:
            pivot += 1
        block = at // BLOCK
        if sum(float(index.block_max[c[2], block]) for c in cursors[:pivot + 1]) < slack:
            behind = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                behind = min(behind, int(items[cursors[pivot + 1][0]]))
            _skip(cursors[:pivot + 1], items, max(behind, at + 1))
        elif items[cursors[0][0]] == at:
            score = sum(float(shares[c[0]]) for c in cursors[:pivot + 1])
            if score >= slack:
                found.append((at, score))
            for c in cursors[:pivot + 1]:
                c[0] += 1
        else:
            _skip(cursors[:pivot], items, at)


def _skip(cursors: list[list], items: np.ndarray, to: int) -> None:
    for c in cursors:
        c[0] += int(np.searchsorted(items[c[0]:c[1]], to))


def _overlaps(item: Item, passage: list[str], shingle: int) -> tuple[float, float]:
    """Shares of the words of question and answer that lie in a run of the item's words which the passage holds; 1.0 for an empty part.

    Runs are a quarter of the part long, two words at least and ``shingle`` at
    most, and may reach into the other part; words of parts of less than four
    words count alone. So one changed, added or dropped word costs at most a
    quarter of the part, or two words, not all shingles around it.
    """
    words, cut = item.question + item.answer, len(item.question)
    shares = []
    for lo, hi in ((0, cut), (cut, len(words))):
        size = hi - lo
        n = 1 if size < 4 else max(1, min(shingle, max(2, size // 4)))
        there = {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)}
        held: set[int] = set()
        for i in range(max(0, lo - n + 1), min(len(words) - n + 1, hi)):
            if words[i:i + n] in there:
                held.update(range(max(i, lo), min(i + n, hi)))
        shares.append(len(held) / size if size else 1.0)
    return shares[0], shares[1]


def find_leaks(texts: list[str | None], index: Index, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(text no., item no., score, question overlap, answer overlap) of every verified pair, best verified passage each.

    Every passage above the threshold is verified in the order of the scores until
    one holds; of passages with that score the one with the largest overlaps counts.
    """
    terms = index.words
    tokens = [words_of(t) for t in texts]
    text_of, chunk_of, term_of = [], [], []
    chunks = 0
    for no, words in enumerate(tokens):
        ids = np.array([terms.get(w, -1) for w in words], dtype=np.int64)
        known = np.flatnonzero(ids >= 0)
        chunk_of.append(known // HALF + chunks)
        term_of.append(ids[known])
        n = max(1, -(-len(words) // HALF))
        text_of.append(np.full(n, no))
        chunks += n
    if not tokens or not len(terms):
        return []
    owner = np.concatenate(text_of)
    half, known = np.concatenate(chunk_of), np.concatenate(term_of)
    # A half counts for the passage it begins and for the one before it in the same text.
    second = (half > 0) & (owner[half] == owner[half - 1])
    pairs = np.unique(np.concatenate((half, half[second] - 1)) * len(terms) + np.concatenate((known, known[second])))
    chunk, term = pairs // len(terms), pairs % len(terms)
    first = np.searchsorted(chunk, np.arange(chunks + 1))
    # The first check of WAND for all passages at once: the best block's maxima of the distinct words, added up.
    bound = np.zeros(chunks, dtype=np.float32)
    filled = np.flatnonzero(first[1:] > first[:-1])
    for at in range(0, len(filled), 512):
        some = filled[at:at + 512]
        lo, hi = first[some[0]], first[some[-1] + 1]
        bound[some] = np.add.reduceat(index.block_max[term[lo:hi]], first[some] - lo, axis=0).max(axis=1)
    begin = np.searchsorted(owner, np.arange(len(tokens)))
    passages: dict[tuple[int, int], list[tuple[float, int]]] = {}
    for c in np.flatnonzero(bound >= threshold - 1e-3):
        for item, score in wand(index, term[first[c]:first[c + 1]].tolist(), threshold):
            passages.setdefault((int(owner[c]), item), []).append((-score, int(c - begin[owner[c]])))
    out = []
    for (no, item), listed in sorted(passages.items()):
        it = index.items[item]
        room = len(it.question) + len(it.answer)
        best: tuple[float, float, float] | None = None
        for rank, half in sorted(listed):
            if best and (-rank < best[0] or best[1] + best[2] == 2.0):
                break
            passage = tokens[no][max(0, half * HALF - room):(half + 2) * HALF + room]
            q, a = _overlaps(it, passage, index.shingle)
            if q >= overlap and a >= overlap and (best is None or q + a > best[1] + best[2]):
                best = (-rank, q, a)
        if best:
            out.append((no, it.item_id, *best))
    return out


def _split(words: Column, answer_share: float) -> tuple[Column, Column]:
    """Question and answer of items that come as one text: the last share of the words is the answer."""
    asked = F.greatest(F.lit(1), F.ceil(F.size(words) * (1 - answer_share))).cast("int")
    return F.slice(words, F.lit(1), asked), F.slice(words, asked + 1, F.greatest(F.size(words) - asked, F.lit(0)))


def indexes(items: DataFrame, key: str = "item_id", text: str = "text", answer: str | None = None, answer_share: float = 1 / 3,
            shingle: int = 5, slice_items: int = SLICE_ITEMS) -> Iterator[Index]:
    """Indexes of all items, a slice of about ``slice_items`` items at a time.

    ``answer`` names a column with the answer; without it the last
    ``answer_share`` of the words is the answer. Items without a word are left out.
    """
    found = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(TOKEN), F.lit(0))
    if answer:
        parts = items.select(F.col(key).alias("item_id"), found(text).alias("question"), found(answer).alias("answer"))
    else:
        question, rest = _split(F.col("words"), answer_share)
        parts = items.select(F.col(key).alias("item_id"), found(text).alias("words")).select("item_id", question.alias("question"), rest.alias("answer"))
    parts = parts.withColumn("words", F.concat("question", "answer")).where(F.size("words") > 0)
    total, mean = parts.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    if not total:
        return
    slices = -(-total // slice_items)
    counted = parts.select("item_id", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    sliced = parts.withColumn("slice", F.pmod(F.xxhash64("item_id", "words"), F.lit(slices)))
    for no in range(slices):
        some = sliced.where(F.col("slice") == no)
        own = some.select(F.explode("words").alias("word")).distinct()
        frequency = {r["word"]: r["n"] for r in counted.join(own, "word").collect()}
        listed = [Item(r["item_id"], tuple(r["question"]), tuple(r["answer"])) for r in some.select("item_id", "question", "answer").collect()]
        yield build_index(sorted(listed, key=lambda i: (i.item_id is None, i.item_id or 0)), frequency, total, mean, shingle)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.6, overlap: float = 0.5,
          **options) -> DataFrame:
    """(key, item_id, score, question_overlap, answer_overlap): every item that a passage of a text holds.

    All passages of all whole texts are queried and every passage and item above
    ``threshold`` verified. Null and empty texts hold nothing; null keys stay null; repeated rows
    give their pairs once each; without items or texts there are no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    found = None
    for index in indexes(items, **options):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(at + no, *rest) for at in range(0, batch.num_rows, TEXTS) for no, *rest in find_leaks(
                    batch.column(1).slice(at, TEXTS).to_pylist(), shared.value, threshold, overlap)]
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *[
                    pa.array([r[i] for r in rows], pa.int64() if i == 1 else pa.float64()) for i in range(1, 5)]],
                    names=["key", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select(key, text).mapInArrow(run, shape)
        found = part if found is None else found.unionByName(part)
    return (found if found is not None else spark.createDataFrame([], shape)).withColumnRenamed("key", key)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = 0.6, overlap: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns as they are, null texts stay."""
    spark = docs.sparkSession
    kept = docs
    for index in indexes(items, **options):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index(text)
                held = {start + r[0] for start in range(0, batch.num_rows, TEXTS) for r in find_leaks(
                    batch.column(at).slice(start, TEXTS).to_pylist(), shared.value, threshold, overlap)}
                yield batch.filter(pa.array([i not in held for i in range(batch.num_rows)], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
