"""Interval operators: overlap counts by sweep inside fixed buckets, and bucketed range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakejobs.operators.ordered import running_totals
from lakejobs.session import written


def epoch_micros(ts: str | Column) -> Column:
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def epoch_to_ntz(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def peak_overlap(
    intervals: DataFrame, keys: list[str], lo: str, hi: str, weights: dict[str, str], bucket_seconds: int = 300
) -> DataFrame:
    """Peak number of open ``[lo, hi]`` intervals (epoch seconds, both ends included) per key and bucket.

    Each interval is cut at bucket borders and turned into +1/-1 changes, which
    are summed per second *before* any window. So the rows of one window group
    are bounded by ``bucket_seconds + 1``, whatever the number of intervals, and
    no per-second row is made for the inside of an interval.
    ``weights`` maps output name to the 0/1 column to add up.
    """
    size = F.lit(bucket_seconds)
    cut = intervals.withColumn(
        "bucket",
        F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long"))),
    )
    first = F.greatest(F.col(lo), F.col("bucket") * size)
    after = F.least(F.col(hi), F.col("bucket") * size + size - 1) + 1
    change = F.explode(
        F.array(
            F.struct(first.alias("second"), F.lit(1).alias("sign")),
            F.struct(after.alias("second"), F.lit(-1).alias("sign")),
        )
    )
    steps = (
        cut.select(*keys, "bucket", change.alias("c"), *weights.values())
        .groupBy(*keys, "bucket", "c.second")
        .agg(*[F.sum(F.col("c.sign") * F.col(w)).alias(name) for name, w in weights.items()])
    )
    order = Window.partitionBy(*keys, "bucket").orderBy("second")
    running = steps.select(*keys, "bucket", *[F.sum(name).over(order).alias(name) for name in weights])
    return running.groupBy(*keys, "bucket").agg(*[F.max(name).alias(name) for name in weights])


def open_at(points: DataFrame, intervals: DataFrame, point: str, lo: str, hi: str, name: str) -> DataFrame:
    """Number of ``[lo, hi]`` intervals (epoch seconds, both ends included) that hold each point.

    Every interval is a +1 at its start and a -1 behind its end, whatever its
    length; a point reads the running sum of the changes up to it. The sum runs in
    slices of the time axis, so busy stretches spread over tasks.
    """
    changes = intervals.select(F.explode(F.array(
        F.struct(F.col(lo).alias("at"), F.lit(1).alias("step")), F.struct((F.col(hi) + 1).alias("at"), F.lit(-1).alias("step")))).alias("c"))
    # Written: the running sum reads its input for the slices, the sums of each and the rows.
    summed = written(changes.groupBy(F.col("c.at").alias("at")).agg(F.sum("c.step").alias("step")))
    asked = points.select(F.col(point).alias("at"), F.lit(1).alias("asks"))
    both = summed.withColumn("asks", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    counted = running_totals(both, [], ["at", "asks"], {name: F.col("step")})
    return counted.where("asks = 1").select(F.col("at").alias(point), name)


def range_join(
    points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str, bucket_seconds: int = 3600,
    keys: list[str] | None = None,
) -> DataFrame:
    """Inner join of points (epoch seconds) to the ``[lo, hi]`` ranges that hold them.

    Both sides get a bucket number, the ranges once per bucket they touch, so the
    join is an equi join with the exact bounds as residual test, not a nested loop.
    ``keys`` are extra equality columns.
    """
    size = F.lit(bucket_seconds)
    left = points.withColumn("_bucket", F.floor(F.col(point) / size).cast("long"))
    right = ranges.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long"))),
    )
    joined = left.join(right, (keys or []) + ["_bucket"])
    return joined.where((F.col(point) >= F.col(lo)) & (F.col(point) <= F.col(hi))).drop("_bucket")
