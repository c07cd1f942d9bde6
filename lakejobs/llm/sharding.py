"""Two-pass external shuffle into shards: scatter by seeded hashes, then Fisher-Yates inside each bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.llm.common import scratch, stored, without

#: Bytes a bucket holds on average; one task shuffles one bucket in memory.
BUCKET_BYTES = 16 * 1024 * 1024
#: Equal rows that stay together; more of them are split, so that no bucket has to hold them all.
COPIES = 1024
#: Tasks of the second pass at most.
TASKS = 100_000


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Shard by highest seeded hash: a further shard takes rows only into itself.

    One hash for each shard and row, so meant for up to some thousands of shards.
    Null keys hash alike and share one shard.
    """
    best = F.array_max(F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.struct(F.xxhash64(key, F.lit(seed), i).alias("weight"), i.alias("shard"))))
    return best["shard"].cast("int")


def scatter(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """First pass: add ``size``, ``shard`` and ``bucket``, a seeded hash of the row, to every row.

    The number of buckets of a shard follows from the bytes of the whole table,
    so a bucket stays near ``bucket_bytes`` at every size of the input. The hash is of the whole
    row (map and variant columns left out); rows that are equal in all columns share a bucket.
    """
    rows = without(docs, "size", "shard", "bucket").withColumn(
        "size", (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long"))
    return _bucketed(rows, shards, bucket_count(docs, shards, text, bucket_bytes), key, seed, _hashed(without(docs, "size", "shard", "bucket")))


def bucket_count(docs: DataFrame, shards: int, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of each shard that ``bucket_bytes`` asks for."""
    size = F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16)
    return docs.agg(F.greatest(F.coalesce(F.ceil(size / (shards * bucket_bytes)), F.lit(1)), F.lit(1))).first()[0]


def _bucketed(rows: DataFrame, shards: int, buckets: int, key: str, seed: int, by: list[Column]) -> DataFrame:
    return rows.withColumn("shard", shard_of(F.col(key), shards, seed)).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 1), *by), F.lit(buckets)).cast("long"))


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes and groups by values of this type."""
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return True


def _hashed(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in docs.schema.fields if _hashable(f.dataType)]


def pieces(docs: DataFrame, most: int = COPIES) -> DataFrame:
    """``docs`` with ``__copies`` and ``__piece``: rows that repeat more than ``most`` times are one row for each ``most`` of them.

    Their hashes are counted first, on the map side; only rows whose hash is that
    frequent are grouped. Tables with columns that cannot be grouped (maps, variants) stay as they are.
    """
    one = [F.lit(1).alias("__copies"), F.lit(0).cast("long").alias("__piece")]
    by = _hashed(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if len(by) < len(columns):
        return docs.select(*columns, *one)
    marked = docs.select(*columns, F.xxhash64(*by).alias("__row"))
    often = stored(marked.groupBy("__row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("__row"), "repeated-rows")
    if often.isEmpty():
        return docs.select(*columns, *one)
    few = marked.join(often, "__row", "left_anti").select(*columns, *one)
    many = marked.join(often, "__row", "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    split = many.select(*columns, "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / most))).alias("__piece"))
    return few.unionByName(split.select(
        *columns, F.least(F.lit(most), F.col("__n") - F.col("__piece") * most).cast("int").alias("__copies"), "__piece"))


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", seed: int = 0,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``shard`` and ``slot``, each bucket in Fisher-Yates order.

    The shuffle of Spark is the external pass: rows go to their bucket by hash.
    The second pass puts a bucket in a fixed order and applies ``shuffle``, the
    Fisher-Yates of Spark SQL, to it. ``slot`` runs from 0 without gaps over a
    shard: buckets one after the other, each in its shuffled order.

    Law ``key``: ``key`` and the number of shards decide the shard. Null keys
    share a shard, null texts count 16 bytes, rows that are equal in all columns
    share buckets, ``COPIES`` at most in one, and each gets a slot of its own, an
    empty table gives no rows, and columns of ``docs`` named like the new ones
    are replaced. Reruns agree, whatever the order of arrival.
    """
    docs = without(docs, "size", "shard", "bucket", "slot", "__copies", "__piece", "__row", "__n")
    columns = docs.columns
    by = _hashed(docs)
    sized = pieces(docs).withColumn("size", (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long"))
    buckets = bucket_count(docs, shards, text, bucket_bytes)
    scattered = _bucketed(sized, shards, buckets, key, seed, [*by, F.col("__piece")])
    in_shard = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scattered.groupBy("shard", "bucket").agg(F.sum("__copies").alias("rows")).select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("first_slot"))
    row = F.struct(
        F.xxhash64(F.lit(seed + 2), *by).alias("order_hash"), F.xxhash64(F.lit(seed + 3), *by).alias("second_hash"),
        F.col("__copies").alias("copies"), F.struct(*[F.col(f"`{c}`") for c in columns], F.col("size")).alias("kept"))

    def before(a: Column, b: Column) -> Column:
        return F.when(a != b, F.when(a < b, -1).otherwise(1))

    # Sorted by 128 bits of the whole row before the shuffle, so the permutation does not depend on the order of arrival.
    in_order = F.array_sort(F.collect_list(row), lambda a, b: F.coalesce(
        before(a["order_hash"], b["order_hash"]), before(a["second_hash"], b["second_hash"]), F.lit(0)))
    # About a bucket a task, and a fixed order of those that share one: the numbers that shuffle draws go on from row to row.
    dealt = scattered.repartition(min(shards * buckets, TASKS), "shard", "bucket")
    whole = dealt.groupBy("shard", "bucket").agg(in_order.alias("rows")).sortWithinPartitions("shard", "bucket")
    shuffled = whole.select("shard", "bucket", F.shuffle(
        F.flatten(F.transform("rows", lambda r: F.array_repeat(r, r["copies"]))), F.lit(seed)).alias("rows"))
    placed = shuffled.join(offsets, ["shard", "bucket"]).select("shard", "first_slot", F.posexplode("rows").alias("at", "row"))
    return placed.select("row.kept.*", "shard", (F.col("first_slot") + F.col("at")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str | None = None, **options) -> str:
    """Write the shards as Parquet folders ``shard=N``; a bucket is one task, so a shard may be many files."""
    out = path or scratch(docs.sparkSession, "shards")
    shard(docs, **options).write.partitionBy("shard").mode("overwrite").parquet(out)
    return out
