"""Resumable chunks, file ranges, stored shredding and the random search."""

import pytest
from pyspark.sql import functions as F

from lakejobs.functions.semi import read_shredded, shred
from lakejobs.ml import models as mo
from lakejobs.operators import chunks, layout


def test_chunks_are_taken_up_where_they_stopped(spark, tmp_path):
    path, built = str(tmp_path / "out"), []
    rows = spark.range(100).select((F.col("id") % 5).cast("int").alias("part"), "id")

    def build(part):
        built.append(part)
        if part == 3 and built.count(3) == 1:
            # Half of a chunk is written when it dies.
            rows.where("part = 3 AND id < 50").write.parquet(f"{path}/part=3")
            raise RuntimeError("stopped")
        return rows.where(F.col("part") == part)

    with pytest.raises(RuntimeError):
        chunks.run_chunks(rows.select("part").distinct(), build, path)
    assert chunks.done_chunks(spark, path).count() == 3
    assert chunks.run_chunks(rows.select("part").distinct(), build, path) == 40
    assert built == [0, 1, 2, 3, 3, 4]
    assert chunks.run_chunks(rows.select("part").distinct(), build, path) == 0
    found = spark.read.parquet(path)
    assert found.count() == 100 and found.select("id").distinct().count() == 100
    assert found.where("part = 3").count() == 20


def test_folded_sum_is_that_of_repeated_rows(spark):
    rows = spark.createDataFrame([(1, 2), (1, None), (2, -3), (2, 10)], "k int, v long")
    repeated = rows.crossJoin(spark.range(7).withColumnRenamed("id", "i")).groupBy("k").agg(F.sum(F.col("v") + F.col("i")).alias("s"))
    assert sorted(map(tuple, rows.groupBy("k").agg(chunks.folded_sum(F.col("v"), 7)).collect())) == sorted(map(tuple, repeated.collect()))


def test_date_table_has_every_day(spark):
    span = spark.sql("SELECT DATE '2024-02-27' AS a, DATE '2024-03-01' AS b")
    found = [tuple(r) for r in chunks.date_table(span, "a", "b").orderBy("d_date").select("d_dom", "d_moy", "d_year").collect()]
    assert found == [(27, 2, 2024), (28, 2, 2024), (29, 2, 2024), (1, 3, 2024)]


def test_opened_share_counts_the_files_of_a_range(spark, tmp_path):
    path = str(tmp_path / "out")
    for lo, hi in ((0, 25), (25, 50), (50, 75), (0, 100)):
        spark.range(lo, hi).withColumn("none", F.lit(None).cast("int")).coalesce(1).write.mode("append").parquet(path)
    ranges = layout.file_ranges(spark.read.parquet(path), ["id", "none"])
    assert sorted((r.low, r.high) for r in ranges.collect()) == [(0, 24), (0, 99), (25, 49), (50, 74)]
    (found,) = layout.opened_share(ranges, 4).collect()
    # Four ranges of a quarter each: the last file is opened by all, the others by one, or two where they begin below a border.
    assert found.files == 4 and found.rows == 175
    expected = sum(sum(lo < b and hi >= a for a, b in ((0, 24.75), (24.75, 49.5), (49.5, 74.25), (74.25, 99.1))) for lo, hi in ((0, 24), (25, 49), (50, 74), (0, 99)))
    assert found.share == expected / 16


def scanned(df):
    """Columns that the scan of a frame reads."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("ReadSchema: "):].splitlines()[0]


def test_shredded_paths_are_read_alone(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "out")
    docs = spark.range(20_000).select("id", F.parse_json(F.to_json(F.struct(
        F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("pad"), F.sha2(F.col("id").cast("string"), 256).alias("more")))).alias("v"))
    paths = {"n": ("$.n", "long")}
    shred(docs, "v", paths).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    one = read_shredded(stored, "v", paths, {"number": ("$.n", "long")}).select("number")
    assert "n:bigint" in scanned(one) and "v:" not in scanned(one) and one.agg(F.sum("number")).first()[0] == sum(range(20_000))
    both = read_shredded(stored, "v", paths, {"number": ("$.n", "long"), "pad": ("$.pad", "string"), "other": ("$.n", "string"), "absent": ("$.x.y", "int")})
    assert "v:" in scanned(both)
    assert tuple(both.where("number = 7").first()) == (7, 7, "8f14e45fceea167a5a36dedd4bea2543", "7", None)
    # Bytes of the column that is read against those of the whole file.
    (file,) = (tmp_path / "out").glob("*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    size = {group.column(i).path_in_schema: group.column(i).total_compressed_size for i in range(group.num_columns)}
    assert size["n"] * 8 < sum(size.values())


def test_random_search_halves_and_repeats(spark):
    rows = spark.range(400).select(
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("b"))
    data = rows.withColumn("label", (F.col("a") + F.col("b") / 4 > 60).cast("double")).coalesce(1)
    space = {"regParam": mo.Range(1e-4, 10.0, log=True), "maxIter": mo.Range(2, 6, whole=True)}
    found = [mo.random_search(data, ["a", "b"], mo.classifier("logistic"), space, trials=8, folds=3, rounds=((0.5, 1, 0.25), (1.0, 3, 0.0))) for _ in range(2)]
    first, second = ([tuple(r) for r in trials.orderBy("round", "trial").collect()] for _, trials in found)
    assert [r[:4] for r in first] == [r[:4] for r in second] and len(first) == 10
    ranked = sorted((r for r in first if r[0] == 1), key=lambda r: r[4])
    assert {r[1] for r in first if r[0] == 2} == {r[1] for r in ranked[:2]}
    assert all(1e-4 <= r[2]["regParam"] <= 10 and r[2]["maxIter"] in (2, 3, 4, 5, 6) for r in first) and len({r[2]["regParam"] for r in first}) == 8
    assert found[0][0].transform(data).where("prediction = label").count() > 360
