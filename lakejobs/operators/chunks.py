"""Large aggregates in resumable chunks, and sums over repeated rows without repeating them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder in which finished chunks are recorded; readers of the table don't see it.
DONE = "_done"


def date_table(span: DataFrame, first: str, last: str) -> DataFrame:
    """A row for each day from ``first`` to ``last``, two date columns of the one row of ``span``."""
    days = span.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias("d_date"))
    return days.select("d_date", F.dayofmonth("d_date").alias("d_dom"), F.month("d_date").alias("d_moy"), F.year("d_date").alias("d_year"))


def folded_sum(value: Column, steps: int) -> Column:
    """Sum of ``value + i`` over all rows and every i from 0 to steps - 1: the rows are never repeated.

    It is steps * sum(value) + rows * steps (steps - 1) / 2; rows without a value give nothing.
    """
    return F.sum(value) * steps + F.count(value) * (steps * (steps - 1) // 2)


def done_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, rows) of the chunks that are finished; none where nothing was run."""
    try:
        return spark.read.schema("chunk string, rows long").parquet(f"{path}/{DONE}")
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], "chunk string, rows long")
        raise


def run_chunks(chunks: DataFrame, build: Callable[[object], DataFrame], path: str) -> int:
    """Compute the rows of each chunk, one after the other in order, into a partition of its own; returns the number of rows written.

    ``chunks`` has one column, whose name is that of the partition. A chunk is recorded
    after its partition is written. A later call passes over recorded chunks and replaces the
    partition of one that died, so a run can be stopped and taken up at any chunk.
    The chunk values come to the driver one at a time.
    """
    spark, name = chunks.sparkSession, chunks.columns[0]
    left = chunks.select(name, F.col(name).cast("string").alias("chunk")).join(done_chunks(spark, path).select("chunk"), "chunk", "left_anti")
    written = 0
    for row in left.orderBy(name).toLocalIterator():
        folder = f"{path}/{name}={row['chunk']}"
        build(row[name]).drop(name).write.mode("overwrite").parquet(folder)
        rows = spark.read.parquet(folder).count()
        spark.createDataFrame([(row["chunk"], rows)], "chunk string, rows long").write.mode("append").parquet(f"{path}/{DONE}")
        written += rows
    return written
