"""Spelling variants: Bloom-guided neighbourhoods of the words of a corpus.

Every word's edits are generated as hashes and probed against Bloom filters of the
vocabulary, one for each word length. What passes is shuffled to an exact join with the
vocabulary, which removes the false positives; so of the hundreds of edits of a word
only a few leave its task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import stored

#: Letters of a word in code point order: a to z and U+00C0 to U+00FF, after A to Z are lower-cased.
LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
RUN = re.compile("[a-zÀ-ÿ]+")
UPPER = re.compile("[A-Z]+")
#: A run is misspelled where this divides its hash.
ERROR = 97
#: Filter bits of a word, and bytes of the filters that are broadcast at once; larger vocabularies are probed slice by slice.
WORD_BITS, FILTER_BYTES = 16, 32 << 20
#: Lengths from here on share a filter.
LONG = 64
#: Words a task holds before it hands on its counts, words whose edits one task probes, and edits probed at a time.
HELD_WORDS, TASK_WORDS, PROBES = 500_000, 20_000, 1_000_000

_STEP = 0x9E3779B97F4A7C15
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_PLACE = np.full(0x100, -1, dtype=np.int64)
_PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each letter; the hash of a word is the sum of its letters' values times powers of the base.
_VALUE = _mix(np.arange(1, len(LETTERS) + 1, dtype=np.uint64) * np.uint64(_STEP))


#: Odd factors that pick the bit of each lane; they have nothing to do with one another, or the lanes would hit together.
_LANES = _mix(np.arange(101, 109, dtype=np.uint64) * np.uint64(_STEP)) & np.uint64(0xFFFFFFFF) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(0, n - 1), _BASE, dtype=np.uint64)))) [:n]


def _letters(words: list[str], length: int) -> np.ndarray:
    """Letter numbers of words of one length, a row each."""
    return _PLACE[np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)].reshape(len(words), length)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes).tolist():
        yield length, np.flatnonzero(sizes == length)


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word."""
    out = np.zeros(len(words), dtype=np.uint64)
    for length, at in _by_length(words):
        power = _powers(length)
        for some in np.array_split(at, max(1, len(at) * length // PROBES)):
            out[some] = (_VALUE[_letters([words[i] for i in some], length)] * power).sum(axis=1, dtype=np.uint64)
    return out


def edits(table: np.ndarray, deletions: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of the edits of words of one length: (hash, row, place, letter number or -1 for a deletion).

    Only deletions and replacements by later letters: an insertion is a deletion
    from the longer word, so every pair of near words is met from one side.
    """
    rows, length = table.shape
    power = _powers(length)
    value = _VALUE[table] * power
    until = np.cumsum(value, axis=1, dtype=np.uint64)
    whole = until[:, -1]
    if deletions:
        after = whole[:, None] - until
        gone = until - value + after * _INVERSE
        # Of equal letters in a row only the first is taken out: the others give the same word.
        first = np.ones(table.shape, bool)
        first[:, 1:] = table[:, 1:] != table[:, :-1]
        row, place = np.nonzero(first)
        yield gone[row, place], row, place, np.full(len(row), -1)
    width = max(1, PROBES // (len(LETTERS) * rows))
    for at in range(0, length, width):
        own = table[:, at:at + width]
        row, place, letter = np.nonzero(own[:, :, None] < np.arange(len(LETTERS)))
        yield whole[row] + (_VALUE[letter] - _VALUE[own[row, place]]) * power[at + place], row, place + at, letter


def _bits(mixed: np.ndarray) -> np.ndarray:
    """One bit for each of the eight lanes of a block."""
    return np.uint64(1) << (((mixed[:, None] & np.uint64(0xFFFFFFFF)) * _LANES & np.uint64(0xFFFFFFFF)) >> np.uint64(26))


def _block(mixed: np.ndarray, blocks: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _slice(mixed: np.ndarray, slices: int) -> np.ndarray:
    return (_mix(mixed + np.uint64(_STEP)) % np.uint64(slices)).astype(np.int64)


def passing(keys: np.ndarray, blocks: np.ndarray, slices: int, own: int) -> np.ndarray:
    """Places of the keys of slice ``own`` that the filter of one length may hold."""
    mixed = _mix(keys)
    at = np.arange(len(keys)) if slices == 1 else np.flatnonzero(_slice(mixed, slices) == own)
    low = mixed[at] & np.uint64(0xFFFFFFFF)
    block = _block(mixed[at], len(blocks))
    for lane in range(8):
        bit = (low * _LANES[lane] & np.uint64(0xFFFFFFFF)) >> np.uint64(26)
        hit = (blocks[block, lane] >> bit) & np.uint64(1) == 1
        at, low, block = at[hit], low[hit], block[hit]
    return at


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3, shortest: int = 5) -> DataFrame:
    """(word, n, h): distinct words of at least ``shortest`` letters and ``least`` occurrences, with their hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                whole = t.as_py()
                lowered = whole.lower() if whole.isascii() else UPPER.sub(lambda m: m.group().lower(), whole)
                before = zlib.crc32(f"{k.as_py()}:".encode())
                for run, n in Counter(RUN.findall(lowered)).items():
                    if len(run) < shortest:
                        continue
                    h = zlib.crc32(run.encode(), before)
                    if h % ERROR == 0:
                        gone = h % len(run)
                        run = run[:gone] + run[gone + 1:]
                        if len(run) < shortest:
                            continue
                    held[run] += n
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        yield counted()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.view(np.int64))], names=["word", "n", "h"])

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stored(words.mapInArrow(hashed, "word string, n long, h long"), "vocabulary")


def filters(words: DataFrame, blocks: dict[int, int], slices: int, own: int) -> dict[int, np.ndarray]:
    """Blocked Bloom filters of the words of one slice: length -> blocks of eight 64-bit lanes.

    Bits are set in the tasks and joined by ``bit_or``; the driver receives a row for each
    block, ``FILTER_BYTES`` in all whatever the vocabulary.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.minimum(np.asarray(batch.column(0)), LONG)
            mixed = _mix(np.asarray(batch.column(1)).view(np.uint64))
            some = np.flatnonzero(_slice(mixed, slices) == own)
            sizes, mixed = sizes[some], mixed[some]
            block = np.zeros(len(mixed), np.int64)
            for length in np.unique(sizes).tolist():
                of = sizes == length
                block[of] = _block(mixed[of], blocks[length])
            lanes = _bits(mixed).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes.astype(np.int32)), pa.array(block), *(pa.array(lanes[:, j]) for j in range(8))],
                names=["length", "block", *(f"lane{j}" for j in range(8))])

    schema = "length int, block long, " + ", ".join(f"lane{j} long" for j in range(8))
    rows = words.select(F.length("word").alias("length"), "h").mapInArrow(run, schema)
    found = rows.groupBy("length", "block").agg(*[F.bit_or(f"lane{j}").alias(f"lane{j}") for j in range(8)]).toArrow()
    out = {length: np.zeros((n, 8), np.uint64) for length, n in blocks.items()}
    sizes, block = np.asarray(found["length"]), np.asarray(found["block"])
    lanes = np.stack([np.asarray(found[f"lane{j}"]).view(np.uint64) for j in range(8)], axis=1)
    for length in blocks:
        of = sizes == length
        out[length][block[of]] = lanes[of]
    return out


def positives(words: DataFrame, shortest: int = 5, word_bits: int = WORD_BITS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(source, key, place, letter): edits that the filters let pass, as hashes; ``letter`` is null for a deletion."""
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()
    total = sum(r["words"] for r in sizes)
    slices = max(1, -(-total * word_bits // (8 * filter_bytes)))
    blocks = {r["length"]: max(1, -(-r["words"] * word_bits // (512 * slices))) for r in sizes}
    spark = words.sparkSession
    dealt = words.select("word", "h").repartition(max(1, -(-total // TASK_WORDS)))
    found = None
    for own in range(slices):
        shared = spark.sparkContext.broadcast(filters(words, blocks, slices, own))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, own=own) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                texts, h = batch.column(0).to_pylist(), np.asarray(batch.column(1))
                for length, at in _by_length(texts):
                    for some in np.array_split(at, max(1, -(-len(at) * length * len(LETTERS) // (2 * PROBES)))):
                        if not len(some):
                            continue
                        table = _letters([texts[i] for i in some], length)
                        for keys, row, place, letter in edits(table, deletions=length > shortest):
                            size = min(length if len(letter) and letter[0] >= 0 else length - 1, LONG)
                            # A long word's edits may be of a length that shares its filter.
                            if size not in known or not len(keys):
                                continue
                            hit = passing(keys, known[size], slices, own)
                            if len(hit):
                                letters = letter[hit]
                                yield pa.RecordBatch.from_arrays([
                                    pa.array(h[some[row[hit]]]), pa.array(keys[hit].view(np.int64)), pa.array(place[hit].astype(np.int32)),
                                    pa.array([LETTERS[x] if x >= 0 else None for x in letters.tolist()], pa.string())],
                                    names=["source", "key", "place", "letter"])

        part = dealt.mapInArrow(run, "source long, key long, place int, letter string")
        part = stored(part, "positives")
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    return found


def near_words(words: DataFrame, shortest: int = 5, **options) -> DataFrame:
    """(word, n, other, other_n): both orders of all pairs that differ by one inserted, deleted or replaced letter.

    Positives meet the vocabulary by hash; the edit is then written out and compared
    with the word it met, so neither the filters nor equal hashes add a pair.
    """
    met = positives(words, shortest, **options).join(words.select(F.col("h").alias("key"), F.col("word").alias("other"), F.col("n").alias("other_n")), "key")
    pairs = met.join(words.select(F.col("h").alias("source"), "word", "n"), "source")
    changed = F.expr("concat(substring(word, 1, place), coalesce(letter, ''), substring(word, place + 2))")
    pairs = stored(pairs.where(changed == F.col("other")).select("word", "n", "other", "other_n").distinct(), "near")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3, shortest: int = 5, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each word of the corpus.

    Words are runs of letters (A-Z lower-cased only) after the seeded misspelling
    of ``crc32("<key>:<run>")``. ``form`` is the most frequent near word, the smallest in code point
    order of several, if it is at least twice as frequent as the word; ``root`` is where
    the forms end. Null and empty texts have no words, a null key counts as an
    empty one, repeated rows count again, very long runs are words like others, an
    empty table gives no rows, and other columns are not read.
    """
    words = vocabulary(docs, key, text, least, shortest)
    # Counts of near words differ from word to word by the alphabet and the length at most, so no group is large.
    best = near_words(words, shortest, **options).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    named = words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), -F.col("best.less")).alias("form_n"))
    named = stored(named, "forms")
    # Each step at least doubles the count, so a chain is short; every round doubles the steps taken.
    steps = stored(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        steps = moved.drop("further")
        if moved.where("further IS NOT NULL").isEmpty():
            break
    return named.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
