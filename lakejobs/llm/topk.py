"""Exact top-k by inner product: distances to pivots bound every candidate, the best bounds are evaluated first."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import stored

#: Pivots, the vectors of the smallest seeded hashes: a bounded sample.
PIVOTS = 32
#: Queries and candidates of a cell of the grid, which one task holds.
QUERY_BLOCK, SLICE_ROWS = 4096, 8192
#: Candidates evaluated at a time after the bounds are sorted.
STEP = 256


def quantized(vector: Column, scale: float = 256.0) -> Column:
    """Components as whole numbers floor(scale * x); null for vectors that are null or hold null or non-finite ones.

    Components are meant to stay below 2**31 after scaling, so that products add up in a long.
    """
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, whole, asks) -> with ``square`` (norm) and ``distances`` to every pivot, once for each vector; shorter vectors end in zeros."""
    width = pivots.shape[1]
    squares = (pivots * pivots).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), width)
            norm = (x * x).sum(axis=1)
            apart = norm[:, None] + squares[None, :] - 2 * (x @ pivots.T)
            far = np.sqrt(np.maximum(apart, 0).astype(np.float64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(list(x), pa.list_(pa.int64())), batch.column(2), pa.array(norm), pa.array(list(far), pa.list_(pa.float64()))],
                names=["vec_id", "whole", "asks", "square", "distances"])

    return vectors.select("vec_id", "whole", "asks").mapInArrow(run, "vec_id long, whole array<long>, asks boolean, square long, distances array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows end in zeros."""
    sizes = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at[i]:at[i] + n]
    return out


def _search(ids, queries, norms, distances, least, k, others, vectors, squares, far) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best ids, best scores, candidates evaluated) of each query among one slice, by bound order until no bound can win.

    |q - c| is at least the largest difference of their pivot distances, so
    q.c = (|q|^2 + |c|^2 - |q - c|^2) / 2 has an upper bound. A small slack keeps
    rounded square roots on the safe side. ``least`` is a score that the k-th best of a query
    reaches at least, found before; what cannot reach it is left out.
    """
    best_score = np.full((len(ids), k), np.iinfo(np.int64).min)
    best_id = np.full((len(ids), k), NONE)
    evaluated = np.zeros(len(ids), np.int64)
    for i in range(len(ids)):
        apart = np.abs(far - distances[i]).max(axis=1)
        bound = (norms[i] + squares - apart * apart) * 0.5
        bound += 1e-6 * (1 + np.abs(norms[i]) + squares)
        open_ = np.flatnonzero(bound >= least[i])
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        for at in range(0, len(open_), STEP):
            part = open_[at:at + STEP]
            if best_id[i, -1] != NONE and bound[part[0]] < best_score[i, -1]:
                break
            part = part[others[part] != ids[i]]
            evaluated[i] += len(part)
            all_score = np.concatenate((best_score[i], vectors[part] @ queries[i]))
            all_id = np.concatenate((best_id[i], others[part]))
            order = np.lexsort((all_id, -all_score, all_id == NONE))
            # A key may be repeated: the best of its rows counts.
            _, first = np.unique(all_id[order], return_index=True)
            order = order[np.sort(first)[:k]]
            best_score[i, :len(order)], best_id[i, :len(order)] = all_score[order], all_id[order]
    return best_id, best_score, evaluated


NONE = np.iinfo(np.int64).max


def _cell(width: int, k: int):
    """Task function of a cell of the grid: queries of a block against candidates of a slice."""
    names = ["query_id", "vec_id", "score", "evaluated"]

    def run(asked: pa.Table, others: pa.Table) -> pa.Table:
        if not asked.num_rows or not others.num_rows:
            none = pa.array([], pa.int64())
            return pa.table([none] * 4, names=names)
        own = [asked[c].combine_chunks() for c in ("vec_id", "whole", "square", "distances", "least")]
        there = [others[c].combine_chunks() for c in ("vec_id", "whole", "square", "distances")]
        far = lambda c: np.asarray(c.flatten()).reshape(len(c), -1)
        ids = np.asarray(own[0])
        best_id, best_score, evaluated = _search(
            ids, _matrix(own[1], width), np.asarray(own[2]), far(own[3]), np.asarray(own[4]), k,
            np.asarray(there[0]), _matrix(there[1], width), np.asarray(there[2]), far(there[3]))
        full = best_id != NONE
        row = np.nonzero(full)[0]
        # A query's count stands on one row, of no candidate, so that it is there without a hit too.
        blank = np.full(len(ids), NONE)
        return pa.table([
            pa.array(np.concatenate((ids[row], ids))), pa.array(np.concatenate((best_id[full], blank))),
            pa.array(np.concatenate((best_score[full], np.zeros(len(ids), np.int64)))),
            pa.array(np.concatenate((np.zeros(len(row), np.int64), evaluated)))], names=names)

    return run


def _grid(asking: DataFrame, table: DataFrame, blocks: int, slices: int, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score, evaluated) of every block of queries against every slice of candidates, a task each."""
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64(F.lit(2), "vec_id", "whole"), F.lit(slices)).cast("int")
    asked = asking.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    others = table.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return asked.groupBy("block", "part").cogroup(others.groupBy("block", "part")).applyInArrow(
        _cell(width, k), "query_id long, vec_id long, score long, evaluated long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of each query; a candidate found by several rows of its key counts once."""
    once = found.where(F.col("vec_id") != NONE).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each query by whole-number inner product.

    Ties go to the smaller ``vec_id``; all rows if there are fewer than ``k``.
    Null vectors, and vectors with null or non-finite components, take no part;
    shorter vectors count as filled up with zeros; rows with a null key are no
    queries and no candidates. A row is no candidate of a query with its own
    key; of rows that repeat a key with other vectors the better one counts, as query and as
    candidate, and equal ones count once. An empty table gives no rows; other columns are not read.
    """
    return _best(evaluate(vectors, is_query, k, key, vector, scale, pivots, query_block, slice_rows), k)


def evaluate(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
             scale: float = 256.0, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(query_id, vec_id, score, evaluated): the best candidates of each query and slice, and on rows without a candidate the number of scores computed.

    Blocks of queries and slices of candidates form a grid dealt by a shuffle, a cell a
    task; nothing but the pivots reaches the driver. The queries first go against one
    slice; the k-th best score there is the first bound of each in all others.
    """
    whole = vectors.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), quantized(F.col(vector), scale).alias("whole"), is_query.alias("asks")).where("whole IS NOT NULL")
    # Equal rows of a key are one row.
    whole = stored(whole.groupBy("vec_id", "whole").agg(F.bool_or("asks").alias("asks")), "vectors")
    spark = vectors.sparkSession
    width, asked, rows = whole.agg(F.max(F.size("whole")), F.count_if("asks"), F.count(F.lit(1))).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, vec_id long, score long, evaluated long")
    width = max(1, width)
    chosen = whole.orderBy(F.xxhash64("vec_id", "whole")).limit(pivots).select("whole").collect()
    seeds = _matrix(pa.array([r["whole"] for r in chosen], pa.list_(pa.int64())), width)
    table = stored(pivot_table(whole, seeds), "pivot-table")
    asking = stored(table.where("asks").drop("asks"), "queries")
    table = table.drop("asks")
    blocks, slices = max(1, math.ceil(asked / query_block)), max(1, math.ceil(rows / slice_rows))
    lowest = F.lit(np.iinfo(np.int64).min).cast("long")
    if slices == 1:
        return _grid(asking.withColumn("least", lowest), table, blocks, 1, width, k)
    # The first slice is an eighth of the others: it only has to give a bound.
    first = F.pmod(F.xxhash64(F.lit(3), "vec_id", "whole"), F.lit(8 * slices)) == 0
    begun = stored(_grid(asking.withColumn("least", lowest), table.where(first), blocks, 1, width, k), "first-slice")
    bounds = _best(begun, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    bounded = asking.join(bounds, "vec_id", "left").select("vec_id", "whole", "square", "distances", F.coalesce("least", lowest).alias("least"))
    return begun.unionByName(_grid(bounded, table.where(~first), blocks, slices, width, k))
