"""SimHash near duplicates: fingerprints, pigeonhole blocks, verification, classes.

Fingerprints are split into blocks. Two of them with few differing bits agree in
some blocks, so they meet under the key made of those blocks, and every pair that
meets is verified. Pairs of one task are reduced to a spanning star before they
leave it, so a group of copies gives as many edges as it has members, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.components import connected_components
from lakejobs.llm.common import stored

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
CHUNK = 32_768
#: Rows under one key that one task compares; keys with more are dealt in pairs of parts.
PART_ROWS = 4096
#: Hot keys the driver keeps; with more of them the parts are made larger. They are looked for in about this many rows.
HOT_KEYS, SAMPLE_ROWS = 100_000, 65_536
#: Texts, and shingles in all, of a part of a group of candidates; groups with more are compared in pairs of parts.
GROUP_ROWS, GROUP_HASHES = 1024, 2_000_000
#: Sets of at least this many shingles differ in the share of bits that their similarity says; smaller ones in more.
LARGE_SET = 64


@dataclass(frozen=True)
class Blocks:
    """Pigeonhole scheme: each 64-bit word is cut into ``blocks``; a key is ``agree`` of them."""

    words: int = 1
    blocks: int = 7
    agree: int = 3
    max_distance: int = 4
    #: First words that the distance counts; 0 for all.
    compared: int = 0
    #: Least shingle similarity of a link; None if the distance alone decides. Then the number of shingles follows the words.
    similarity: float | None = None
    #: Limit of the distance of two sets of at least ``LARGE_SET`` shingles.
    max_distance_large: int = 0

    def choices(self) -> list[list[tuple[int, int]]]:
        """(first bit, width) of the blocks of each key."""
        edges = [round(i * 64 / self.blocks) for i in range(self.blocks + 1)]
        return [[(edges[i], edges[i + 1] - edges[i]) for i in chosen] for chosen in combinations(range(self.blocks), self.agree)]


#: Complete for 4 differing bits of 64: at least 3 of 7 blocks are equal.
EXACT_64 = Blocks()


def similar(similarity: float, words: int = 6) -> Blocks:
    """Scheme for shingle sets of at least this Jaccard similarity, by ``words`` independent 64-bit SimHashes.

    Sets of similarity s have cosine 2s / (1 + s) when equally large (more when
    not), and each bit differs with probability angle / pi; sets of few shingles
    differ in up to 3 of 16 bits. A pair is a candidate if in one of the words
    two of eight blocks agree, the first two words differ by at most that
    share and four standard deviations, and the numbers of shingles allow the
    similarity. A candidate becomes a link only if its shingle sets have it.
    """
    large = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    compared = min(2, words)
    bits = 64 * compared
    small, large = (int(share * bits + 4 * (bits * share * (1 - share)) ** 0.5) for share in (max(3 / 16, large), large))
    return Blocks(words=words, blocks=8, agree=2, max_distance=small, compared=compared, similarity=similarity, max_distance_large=large)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads a 64-bit value over all bits."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _shingles(text: str | None, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles, ``CHUNK`` at a time; nothing for a text without a word."""
    tokens = WORDS.findall((text or "").translate(UPPER))
    if not tokens:
        return
    joined = " ".join(tokens).encode("utf-8", "surrogatepass")
    ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in tokens]) if not joined.isascii() else np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    count = max(1, len(tokens) - shingle + 1)
    width = min(shingle, len(tokens)) - 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, CHUNK):
        until = min(count, at + CHUNK)
        yield np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[at:until], ends[at + width:until + width])), np.uint64, until - at)


def _print(chunks: Iterable[np.ndarray], words: int) -> bytes:
    ones, count = np.zeros(64 * words, dtype=np.int64), 0
    for first in chunks:
        count += len(first)
        for w in range(words):
            hashes = first if w == 0 else _mix(first + np.uint64((w * 0x9E3779B97F4A7C15) & (2**64 - 1)))
            bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[64 * w:64 * (w + 1)] += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > count).tobytes()


def fingerprint(text: str | None, shingle: int, words: int, seed: int = 42) -> bytes:
    """``words`` 64-bit SimHashes of the word shingles, big-endian; the first one is of the plain XXH64."""
    return _print(_shingles(text, shingle, seed), words)


def shingle_set(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """Distinct hashes of the word shingles, in order."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_shingles(text, shingle, seed)]))


def set_fingerprint(hashes: np.ndarray, words: int) -> bytes:
    """``words`` SimHashes in which every distinct shingle counts once."""
    return _print((hashes[at:at + CHUNK] for at in range(0, len(hashes), CHUNK)), words)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, words: int = 1) -> DataFrame:
    """(key, text_hash, fingerprint binary) of every row. Null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle, words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.binary())], names=["key", "text_hash", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.xxhash64(text).alias("text_hash"), text).mapInArrow(run, f"key {kind}, text_hash long, fingerprint binary")


def _keys(table: np.ndarray, scheme: Blocks) -> Iterator[np.ndarray]:
    """Keys of all rows, one array for each word and choice of blocks: the blocks' bits behind the number of the choice."""
    choices = scheme.choices()
    for w in range(scheme.words):
        for m, blocks in enumerate(choices):
            key = np.full(len(table), w * len(choices) + m, dtype=np.uint64)
            for first, width in blocks:
                key = key << np.uint64(width) | table[:, w] >> np.uint64(first) & np.uint64((1 << width) - 1)
            yield key.view(np.int64)


def _table(prints: pa.Array) -> np.ndarray:
    """64-bit words of the fingerprints, a row each."""
    return np.frombuffer(b"".join(v.as_py() for v in prints), dtype=">u8").reshape(len(prints), -1).astype(np.uint64)


def _key_batches(scheme: Blocks, parts: dict[int, int]):
    """Task function: (id, fingerprint) -> (key, part, id, what is compared)."""
    hot = np.array(sorted(parts), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0), dtype=np.int64)
            table = _table(batch.column(1))
            # What is compared and the number of shingles, if it follows the words.
            raw = (np.delete(table, np.s_[scheme.compared:scheme.words], axis=1) if scheme.compared else table).astype(">u8").tobytes()
            for keys in _keys(table, scheme):
                rest = ~np.isin(keys, hot) if len(hot) else np.ones(len(keys), bool)
                yield _key_batch(keys[rest], np.full(int(rest.sum()), -1, np.int32), ids[rest], raw, len(raw) // len(ids), np.flatnonzero(rest))
                for at in np.flatnonzero(~rest):
                    n = parts[int(keys[at])]
                    own = int(_mix(np.array([ids[at]], dtype=np.int64).view(np.uint64))[0] % np.uint64(n))
                    pairs = np.array([min(own, j) * n + max(own, j) for j in range(n)], dtype=np.int32)
                    yield _key_batch(np.full(n, keys[at]), pairs, np.full(n, ids[at]), raw, len(raw) // len(ids), np.full(n, at))

    return run


def hot_keys(prints: DataFrame, scheme: Blocks) -> dict[int, int]:
    """Keys of more than about ``PART_ROWS`` rows and the parts each is dealt in.

    Counted in a seeded sample of about ``SAMPLE_ROWS`` rows (all, if there are no more), in the
    JVM, so neither the number of tasks nor their size matters. Only the dealing depends on it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for keys in _keys(_table(batch.column(1)), scheme):
                    yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

    share = min(1.0, SAMPLE_ROWS / max(1, prints.count()))
    sampled = prints.where(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_003)) < share * 1_000_003)
    rows, least = PART_ROWS, 1 if share == 1 else 8
    counted = sampled.select("id", "fingerprint").mapInArrow(run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    counted = stored(counted.where((F.col("rows") >= least) & (F.col("rows") / share >= rows // 2)), "hot")
    while True:
        seen = counted.where(F.col("rows") / share >= rows // 2).limit(HOT_KEYS + 1).collect()
        if len(seen) <= HOT_KEYS:
            return {r["key"]: int(-(-(r["rows"] / share + rows) // rows)) for r in seen}
        rows *= 2


def _key_batch(keys, part, ids, raw, size, at) -> pa.RecordBatch:
    prints = pa.array([raw[i * size:(i + 1) * size] for i in at.tolist()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part), pa.array(ids), prints], names=["key", "part", "id", "fingerprint"])


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node linked to it) that keep the components of the pairs (a, b)."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _close(keys: np.ndarray, part: np.ndarray, table: np.ndarray, scheme: Blocks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places with equal (key, part), which come one after the other, that are candidates of the scheme."""
    words = scheme.compared or scheme.words
    n = len(keys)
    new = np.ones(n, bool)
    new[1:] = (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])
    run = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], n)[run]
    at = np.arange(n)
    step = 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            return
        limit = scheme.max_distance
        apart = np.bitwise_count(table[at, :words] ^ table[at + step, :words]).sum(axis=1, dtype=np.int32)
        if scheme.similarity is not None:
            small, large = (f(table[at, words], table[at + step, words]) for f in (np.minimum, np.maximum))
            limit = np.where(small >= LARGE_SET, scheme.max_distance_large, limit)
            # Empty sets are one class, so no two of them meet.
            apart = np.where(small / np.maximum(large, 1) >= scheme.similarity, apart, np.iinfo(np.int32).max)
        close = apart <= limit
        if close.any():
            yield at[close], at[close] + step
        step += 1


def _linked(keys: np.ndarray, part: np.ndarray, ids: np.ndarray, table: np.ndarray, scheme: Blocks) -> pa.RecordBatch:
    """Spanning stars (a, b) of all candidate pairs among rows of equal (key, part)."""
    found_a, found_b, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for left, right in _close(keys, part, table, scheme):
        found_a.append(ids[left])
        found_b.append(ids[right])
        held += len(left)
        if held > 2_000_000:
            a, b = _stars(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, held = [a], [b], len(a)
    return _edges(*_stars(np.concatenate(found_a), np.concatenate(found_b)))


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(prints: DataFrame, scheme: Blocks = EXACT_64, partitions: int | None = None) -> DataFrame:
    """Edges (a, b) that join all candidate pairs of ``prints`` (id long, fingerprint binary; ids unique).

    Keys with many rows are dealt as pairs of parts, so any group is compared whole and
    in pieces of about twice ``PART_ROWS`` rows.
    """
    spark = prints.sparkSession
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.mapInArrow(_key_batches(scheme, hot_keys(prints, scheme)), "key long, part int, id long, fingerprint binary")
    dealt = keyed.repartition(wanted, "key", "part").sortWithinPartitions("key", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            keys, part, ids, table = (np.concatenate(x) for x in zip(*held))
            cut = len(keys)
            if not last:
                same = (keys == keys[-1]) & (part == part[-1])
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = [(keys[cut:], part[cut:], ids[cut:], table[cut:])]
            size = len(keys) - cut
            if cut:
                yield _linked(keys[:cut], part[:cut], ids[:cut], table[:cut], scheme)

        for batch in batches:
            if batch.num_rows:
                held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2)), _table(batch.column(3))))
                size += batch.num_rows
            if size >= 100_000:
                yield from flush(False)
        if held:
            yield from flush(True)

    return dealt.mapInArrow(run, "a long, b long")


def set_fingerprints(docs: DataFrame, key: str, text: str, shingle: int, words: int) -> DataFrame:
    """(key, text_hash, fingerprint binary, id, shingles) of every row; equal shingle sets have equal ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, ids, sizes = [], [], []
            for t in batch.column(2):
                hashes = shingle_set(t.as_py(), shingle)
                prints.append(set_fingerprint(hashes, words))
                ids.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sizes.append(len(hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(
                np.array(ids, np.uint64).view(np.int64)), pa.array(sizes, pa.int64())], names=["key", "text_hash", "fingerprint", "id", "shingles"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.xxhash64(text).alias("text_hash"), text).mapInArrow(
        run, f"key {kind}, text_hash long, fingerprint binary, id long, shingles long")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common values of two sorted arrays without repeats."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def set_links(sets: list[np.ndarray], side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (place, place) that join all pairs of sets with at least this Jaccard similarity.

    Sets are sorted arrays; where ``side`` has two values only pairs across are compared.
    Two such sets share one of their rarest hashes (as many as may be missing, and one), so only
    these are looked up; a pair already joined by other links is not tested again.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, token, counts = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((token, counts[token], owner))
    token = token[order]
    # Hashes that one set alone has can be left out of the lookup: nobody shares them.
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rare = (place < np.repeat(sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1, sizes)) & (counts[token] > 1)
    token, owner = token[rare], owner[rare]
    by_token = np.argsort(token, kind="stable")
    sorted_token, member = token[by_token], owner[by_token]
    first, last = np.searchsorted(sorted_token, token, "left"), np.searchsorted(sorted_token, token, "right")
    starts = np.searchsorted(owner, np.arange(len(sets) + 1))
    two_sided = len(np.unique(side)) > 1
    label = np.arange(len(sets))
    found: list[tuple[int, int]] = []
    for x in range(len(sets)):
        lists = [member[a:b] for a, b in zip(first[starts[x]:starts[x + 1]].tolist(), last[starts[x]:starts[x + 1]].tolist()) if b - a > 1]
        if not lists:
            continue
        near = np.unique(np.concatenate(lists))
        near = near[near > x]
        if two_sided:
            near = near[side[near] != side[x]]
        near = near[np.minimum(sizes[near], sizes[x]) / np.maximum(sizes[near], sizes[x]) >= similarity]
        while True:
            near = near[label[near] != label[x]]
            if not len(near):
                break
            y, near = int(near[0]), near[1:]
            both = _shared(sets[x], sets[y])
            if both / (sizes[x] + sizes[y] - both) >= similarity:
                found.append((x, y))
                label[label == label[y]] = label[x]
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _group_links(shingle: int, similarity: float):
    """Task function: (group, part, side, id, text), sorted by (group, part) -> links (a, b) that join all similar texts of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sides, sets = None, [], [], []

        def compared() -> pa.RecordBatch:
            a, b = set_links(sets, np.array(sides), similarity) if len(sets) > 1 else (np.empty(0, np.int64),) * 2
            own = np.array(ids, dtype=np.int64)
            return _edges(own[a], own[b])

        for batch in batches:
            groups, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row in range(batch.num_rows):
                if (groups[row], parts[row]) != now:
                    if len(sets) > 1:
                        yield compared()
                    now, ids, sides, sets = (groups[row], parts[row]), [], [], []
                sides.append(batch.column(2)[row].as_py())
                ids.append(batch.column(3)[row].as_py())
                sets.append(shingle_set(batch.column(4)[row].as_py(), shingle))
        yield compared()

    return run


def _similar_links(docs: DataFrame, classes: DataFrame, text: str, shingle: int, scheme: Blocks) -> DataFrame:
    """Links (a, b) that join all candidates among ``classes`` whose shingle sets have the similarity.

    Candidates that hang together are a group. The texts of a group meet in a task, or
    if they are many in a task for each two parts of the group, which compares their shingle
    sets exactly; only the links that join similar texts leave it, never the candidates.
    """
    size = F.unhex(F.lpad(F.hex("shingles"), 16, "0"))
    candidates = stored(links(classes.select("id", F.concat("fingerprint", size).alias("fingerprint")), scheme), "candidates")
    groups = connected_components(candidates).select(F.col("node").alias("id"), F.col("component").alias("group"))
    member = stored(groups.join(classes.select("id", "text_hash", "shingles"), "id"), "members")
    parts = member.groupBy("group").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / GROUP_ROWS), F.ceil(F.sum("shingles") / GROUP_HASHES), F.lit(1)).cast("int").alias("parts"))
    wanted = member.join(parts, "group").select("id", "group", "parts", "text_hash")
    texts = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")).join(wanted, "text_hash")
    one = texts.groupBy("id", "group", "parts").agg(F.first("text").alias("text"))
    own = F.pmod(F.xxhash64(F.lit(3), "id"), F.col("parts")).cast("int")
    each = one.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part = F.least("side", "other") * F.col("parts") + F.greatest("side", "other")
    # Inside a part all pairs are compared by the task of (part, part), so elsewhere only pairs across.
    dealt = each.select("group", part.alias("part"), "side", "id", "text").repartition("group", "part").sortWithinPartitions("group", "part")
    return stored(dealt.mapInArrow(_group_links(shingle, scheme.similarity), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, scheme: Blocks = EXACT_64) -> DataFrame:
    """(key, fingerprint hex, component_id): one row for each row of ``docs``.

    ``component_id`` is the smallest key reachable over links of at most
    ``scheme.max_distance`` differing bits, or with ``scheme.similarity`` over
    candidates verified by their shingle sets; equal fingerprints (or sets) are one class from
    the start, so copies meet once. Null and empty texts have fingerprint zero and
    link like any other; rows with a null key keep a null key and count as
    larger than any other, so a group of them alone has a null component;
    repeated rows are rows of their own; an empty table gives no rows.
    """
    return _components(docs, key, text, shingle, scheme).select(
        F.col("key").alias(key), F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, key: str, text: str, shingle: int, scheme: Blocks) -> DataFrame:
    """(key, text_hash, fingerprint, component, component_id) of every row: its class's component and the smallest key in it."""
    if scheme.similarity is not None:
        by = "id"
        prints = stored(set_fingerprints(docs, key, text, shingle, scheme.words), "fingerprints")
        classes = stored(prints.groupBy("id", "fingerprint", "shingles").agg(F.min("key").alias("low"), F.min("text_hash").alias("text_hash")), "classes")
        found = connected_components(_similar_links(docs, classes, text, shingle, scheme))
    else:
        by = "fingerprint"
        prints = stored(fingerprints(docs, key, text, shingle, scheme.words), "fingerprints")
        classes = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("low")).withColumn(
            "id", F.xxhash64("fingerprint") if scheme.words > 1 else F.conv(F.hex("fingerprint"), 16, -10).cast("long")), "classes")
        found = connected_components(links(classes.select("id", "fingerprint"), scheme))
    member = classes.join(found, classes["id"] == found["node"], "left").select(
        classes[by], "low", F.coalesce("component", "id").alias("component"))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    return prints.join(member.join(lowest, "component").select(by, "component", "component_id"), by)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, scheme: Blocks = EXACT_64) -> DataFrame:
    """One row of each class of near duplicates, with all columns of ``docs``: the smallest key, then the smallest fingerprint.

    Texts without a word are no copies of one another and all stay, as do rows with
    a null key. A key that is repeated with other texts counts as a row of each: of every class one
    (key, text) stays, and of rows that repeat both one.
    """
    columns = docs.columns
    wordless = ~F.coalesce(F.regexp_like(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)) | F.col(key).isNull()
    classes = _components(docs.where(~wordless).select(key, text), key, text, shingle, scheme)
    best = classes.groupBy("component").agg(F.min(F.struct("key", "fingerprint", "text_hash")).alias("best"))
    kept = stored(best.select(F.col("best.key").alias("__kept"), F.col("best.text_hash").alias("__text")), "kept")
    hashed = docs.where(~wordless).withColumn("__hash", F.xxhash64(text))
    ranked = hashed.join(kept, (F.col(key) == F.col("__kept")) & (F.col("__hash") == F.col("__text")), "left_semi")
    return ranked.dropDuplicates([key, "__hash"]).drop("__hash").unionByName(docs.where(wordless)).select(*[F.col(f"`{c}`") for c in columns])
