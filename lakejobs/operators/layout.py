"""File layout: clustering, Z-order, compaction and key advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.ordered import dense_number


def cluster(df: DataFrame, keys: list[str], files: int) -> DataFrame:
    """Range-partition by up to four keys and sort inside, so file min/max ranges barely overlap."""
    if not 1 <= len(keys) <= 4:
        raise ValueError("cluster by one to four keys")
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


def z_value(positions: list[Column], bits: int) -> Column:
    """Interleave the lowest ``bits`` bits of each position, highest bit first."""
    value = F.lit(0).cast("long")
    for bit in range(bits):
        for i, position in enumerate(positions):
            digit = F.shiftright(position, bit).bitwiseAND(F.lit(1))
            value = value.bitwiseOR(F.shiftleft(digit.cast("long"), bit * len(positions) + i))
    return value


def zorder(df: DataFrame, columns: list[str], files: int, bits: int = 10) -> DataFrame:
    """Cluster by an interleaved order of the columns' quantile positions.

    Positions are quantile ranks scaled to the same range, so a skewed column or
    one with few values still uses all bits. Only the border values reach the driver.
    """
    from pyspark.ml.feature import Bucketizer

    from lakejobs.operators.ordered import axis

    steps = 2**bits
    placed, names = df, []
    shares = [i / steps for i in range(1, steps)]
    quantiles = df.agg(*[F.percentile_approx(axis(df, c), shares, 20_000).alias(c) for c in columns]).first()
    for c in columns:
        borders = sorted(set(quantiles[c] or []))
        splits = [float("-inf"), *borders, float("inf")]
        placed = Bucketizer(splits=splits, inputCol="_axis", outputCol=f"_z_{c}", handleInvalid="keep").transform(
            placed.withColumn("_axis", axis(df, c))).drop("_axis")
        names.append(F.floor(F.col(f"_z_{c}") * steps / (len(borders) + 1)).cast("int"))
    ordered = placed.withColumn("_z", z_value(names, bits))
    return ordered.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop(
        "_z", *[f"_z_{c}" for c in columns])


def compact(df: DataFrame, total_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Few files of about the target size; rows move only between tasks that are merged."""
    return df.coalesce(max(1, -(-total_bytes // target_bytes)))


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file a frame is read from."""
    meta = df.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    return meta.groupBy("file_path").agg(F.count("*").alias("row_count"), F.max("file_size").alias("file_size"))


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(file_path, column_name, rows, low, high): least and greatest value of each column in each file, as positions on ``axis``.

    Counted from the rows, as a table format's statistics would have them; files without a value have no row.
    """
    from lakejobs.operators.ordered import axis

    whole = df.select(F.col("_metadata.file_path").alias("file_path"), *[axis(df, c).alias(c) for c in columns])
    found = whole.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high")) for c in columns]))
    return found.select("file_path", "rows", each.alias("of")).select("file_path", "of.column_name", "rows", "of.low", "of.high").where("low IS NOT NULL")


def opened_share(ranges: DataFrame, probes: int) -> DataFrame:
    """(column_name, files, rows, share): share of the files that a filter on one of ``probes`` equal ranges of a column has to open, on average.

    Each file counts the ranges it touches by arithmetic, so nothing is joined for it.
    """
    span = ranges.groupBy("column_name").agg(
        F.min("low").alias("least"), F.max("high").alias("most"), F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    width = F.greatest((F.col("most") - F.col("least")) / probes, F.lit(1e-300))
    number = lambda c: F.least(F.floor((F.col(c) - F.col("least")) / width), F.lit(probes - 1))
    touched = ranges.select("column_name", "low", "high").join(span, "column_name").withColumn("touched", number("high") - number("low") + 1)
    return touched.groupBy("column_name", "files", "rows").agg((F.sum("touched") / F.count(F.lit(1)) / probes).alias("share"))


def advise_keys(filters: DataFrame, stats: DataFrame, limit: int = 4, least_values: int = 100) -> DataFrame:
    """Rank filter columns as cluster keys: most used first, columns with few values left out."""
    counted = filters.groupBy("column_name").agg(F.count("*").alias("filter_count"))
    useful = stats.where(F.col("ndv") > least_values).select("column_name")
    ranked = counted.join(useful, "column_name").withColumn("_order", -F.col("filter_count"))
    return dense_number(ranked, ["_order", "column_name"], "key_rank").drop("_order").where(F.col("key_rank") <= limit)
