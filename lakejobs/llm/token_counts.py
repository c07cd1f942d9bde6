"""Exact token lengths: one histogram answers totals, quantiles and truncated totals for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import stored

#: Lengths of a range; ranges are summed first, so no task orders more lengths than this.
RANGE = 128
#: Vocabulary file of a public byte-level BPE; pass another path where it lies elsewhere.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def encoder(ranks: str, pattern: str):
    """Byte-level BPE of a public vocabulary file, loaded once in each Python worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("lengths", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def split_pattern() -> str:
    """The pre-tokenizer pattern that goes with the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoded_lengths(docs: DataFrame, text: str = "text", ranks: str = RANKS, pattern: str | None = None) -> DataFrame:
    """One row (tokens) for each row of ``docs``; null and empty texts have 0 tokens.

    ``ranks`` names the vocabulary file, which every executor must have.
    """
    pattern = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(encode(t.as_py() or "")) for t in batch.column(0)], pa.int64())], names=["tokens"])

    return docs.select(text).mapInArrow(run, "tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(tokens) -> (tokens, documents), summed on the map side."""
    return lengths.groupBy("tokens").agg(F.count(F.lit(1)).alias("documents"))


def limits(counts: DataFrame, width: int = RANGE) -> DataFrame:
    """Answers of the histogram for each length that occurs, taken as a context limit L.

    ``documents_over`` and ``tokens_over``: documents longer than L and their
    tokens; ``truncated_tokens``: the total when every text is cut at L;
    ``quantile``: share of documents with at most L tokens; ``total_documents``
    and ``total_tokens`` of the corpus. ``at_limits`` answers limits between two lengths.
    Suffix sums run over ranges of lengths first and inside a range then.
    """
    ranged = counts.withColumn("range", F.floor(F.col("tokens") / width))
    above = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranged.groupBy("range").agg(
        F.sum("documents").alias("d"), F.sum(F.col("documents") * F.col("tokens")).alias("t")).select(
        "range", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(whole).alias("total_documents"), F.sum("t").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("range").orderBy(F.col("tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    over_d = F.col("d_above") + F.coalesce(F.sum("documents").over(inside), F.lit(0))
    over_t = F.col("t_above") + F.coalesce(F.sum(F.col("documents") * F.col("tokens")).over(inside), F.lit(0))
    summed = ranged.join(ranges, "range").select(
        "tokens", "documents", over_d.alias("documents_over"), over_t.alias("tokens_over"), "total_documents", "total_tokens")
    return summed.select(
        F.col("tokens").alias("context_limit"), "documents", "documents_over", "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("documents_over") * F.col("tokens")).alias("truncated_tokens"),
        ((F.col("total_documents") - F.col("documents_over")) / F.col("total_documents")).alias("quantile"),
        "total_documents", "total_tokens")


def at_limits(counts: DataFrame, wanted: Sequence[int]) -> DataFrame:
    """The answers of ``limits`` for any context limits, between two lengths too, from the histogram: one row for each of ``wanted``.

    All limits are answered by one aggregate; an empty histogram gives zeros and a null quantile.
    """
    n, length = F.col("documents"), F.col("tokens")
    sums = [F.sum(n).alias("total_documents"), F.sum(n * length).alias("total_tokens")]
    for i, limit in enumerate(wanted):
        over = length > limit
        sums += [F.sum(F.when(over, n).otherwise(0)).alias(f"d{i}"), F.sum(F.when(over, n * length).otherwise(0)).alias(f"t{i}"),
                 F.sum(n * F.least(length, F.lit(limit))).alias(f"c{i}")]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    each = F.array(*[F.struct(F.lit(limit).cast("long").alias("context_limit"), zero(f"d{i}").alias("documents_over"), zero(f"t{i}").alias("tokens_over"),
                              zero(f"c{i}").alias("truncated_tokens")) for i, limit in enumerate(wanted)])
    rows = counts.agg(*sums).select(zero("total_documents").alias("total_documents"), zero("total_tokens").alias("total_tokens"), F.explode(each).alias("a"))
    return rows.select("a.*", F.try_divide(F.col("total_documents") - F.col("a.documents_over"), F.col("total_documents")).alias("quantile"),
                       "total_documents", "total_tokens")


def token_counts(docs: DataFrame, text: str = "text", ranks: str = RANKS, pattern: str | None = None) -> DataFrame:
    """The answers of ``limits`` over all whole texts; an empty table gives no rows, other columns play no part."""
    # The histogram is read three times; it is written once, so that texts are encoded once.
    return limits(stored(histogram(encoded_lengths(docs, text, ranks, pattern)), "lengths"))
