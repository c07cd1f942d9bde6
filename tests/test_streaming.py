"""Row rules and streams: batch and stream agree, batches apply once."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakejobs.operators.versions import VersionedTable
from lakejobs.sources import files
from lakejobs.streaming import sinks
from lakejobs.streaming.rules import expect_fail, expect_warn, rule_report


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_warn_counts_and_keeps(tables):
    seen = Observation("r")
    kept = expect_warn(tables.events, "r", {"big": F.col("value") > 50, "unknown": F.lit(None).cast("boolean")}, seen)
    assert kept.count() == 1000
    got = seen.get
    assert got["big_passed"] + got["big_failed"] == got["rows"] == 1000 and got["unknown_failed"] == 1000
    report = rule_report(tables.events, "events", {"big": F.col("value") > 50}).first()
    assert report["passed"] == got["big_passed"]


def test_fail_stops_the_job(tables):
    with pytest.raises(Exception, match="rule big failed"):
        expect_fail(tables.events, {"big": F.col("value") > 50}).collect()


def test_upsert_stream_applies_each_batch_once(spark, tmp_path):
    root = str(tmp_path)
    table = VersionedTable(spark, f"{root}/t")
    table.create(spark.createDataFrame([(1, "old", 0)], "id long, v string, seq int"))
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, seq int").coalesce(1).write.parquet(f"{root}/in")
    stream = files.stream_parquet(spark, f"{root}/in")
    sinks.upsert_batches(stream, table, ["id"], ["seq"], f"{root}/c").awaitTermination()
    assert rows(table.read()) == [(1, "b", 2), (2, "c", 1)]
    # The same batch again with a lost checkpoint is recognised by its number.
    sinks.upsert_batches(stream, table, ["id"], ["seq"], f"{root}/c2").awaitTermination()
    assert table.history().count() == 2


def test_widened_stream_goes_on(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, 20)], "sensor int, temperature int").write.json(f"{root}/in")
    wide = files.stream_json(spark, f"{root}/in", "sensor int, temperature bigint")
    sinks.append_files(wide, f"{root}/out", f"{root}/c").awaitTermination()
    spark.createDataFrame([(2, 5_000_000_000)], "sensor int, temperature bigint").write.mode("append").json(f"{root}/in")
    sinks.append_files(wide, f"{root}/out", f"{root}/c").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/out")) == [(1, 20), (2, 5_000_000_000)]


def test_refresh_touches_only_new_days(spark, tables, tmp_path):
    from lakejobs.plans.jobs import daily_totals

    root = str(tmp_path)
    dated = tables.events.withColumn("day", F.to_date("ts"))
    dated.where("day < DATE '2024-01-20'").write.parquet(f"{root}/in")

    def refresh():
        sinks.refresh_days(
            spark, lambda: spark.read.parquet(f"{root}/in"), files.stream_parquet(spark, f"{root}/in"), f"{root}/out", "day",
            lambda df: daily_totals(df), f"{root}/c").awaitTermination()

    refresh()
    stamp = {r[0]: r[1] for r in spark.read.parquet(f"{root}/out").select("day", F.col("_metadata.file_path")).distinct().collect()}
    dated.where("day >= DATE '2024-01-20'").write.mode("append").parquet(f"{root}/in")
    refresh()
    again = spark.read.parquet(f"{root}/out")
    assert rows(again.select("day", "event_type", "n", "total")) == rows(daily_totals(tables.events))
    now = {r[0]: r[1] for r in again.select("day", F.col("_metadata.file_path")).distinct().collect()}
    assert all(now[d] == p for d, p in stamp.items())


def test_dedup_keeps_one_per_key(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts FROM VALUES (1), (1), (2) t(id)").write.parquet(f"{root}/in")
    out = sinks.dedup(files.stream_parquet(spark, f"{root}/in"), ["id"], "ts", "1 hour")
    sinks.append_files(out, f"{root}/out", f"{root}/c").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2]


def keyed(spark, root):
    sinks.create_keyed(spark.createDataFrame([(i, "old", 5) for i in range(40)], "id long, v string, seq int"), f"{root}/t", ["id"], 8)
    return files.stream_parquet(spark, f"{root}/in", maxFilesPerTrigger="1")


def part_files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}


def test_upsert_rewrites_only_the_partitions_of_a_batch(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, "a", 6), (1, "b", 7), (2, "late", 4), (99, "new", 1), (None, "no key", 1)], "id long, v string, seq int").coalesce(1).write.parquet(f"{root}/in")
    rows_in = keyed(spark, root)
    before = part_files(spark, f"{root}/t")
    sinks.upsert_partitions(rows_in, f"{root}/t", ["id"], ["seq"], 8, f"{root}/c").awaitTermination()
    found = {r.id: (r.v, r.seq) for r in sinks.read_keyed(spark, f"{root}/t").collect()}
    assert found == {**{i: ("old", 5) for i in range(40)}, 1: ("b", 7), 99: ("new", 1), None: ("no key", 1)}
    after = part_files(spark, f"{root}/t")
    assert 0 < len(before - after) <= 4 and before & after
    # The same batch with a lost checkpoint, and a batch that died before it was recorded, change nothing.
    sinks.upsert_partitions(rows_in, f"{root}/t", ["id"], ["seq"], 8, f"{root}/c2").awaitTermination()
    assert part_files(spark, f"{root}/t") == after
    spark.createDataFrame([], "batch long, partitions int").write.mode("overwrite").parquet(f"{root}/t/{sinks.LEDGER}")
    sinks.upsert_partitions(rows_in, f"{root}/t", ["id"], ["seq"], 8, f"{root}/c3").awaitTermination()
    again = [(r.id, r.v, r.seq) for r in sinks.read_keyed(spark, f"{root}/t").collect()]
    assert len([x for x in again if x[0] is not None]) == 41 and {x[0]: x[1:] for x in again} == found


def test_progress_of_all_batches_is_stored(spark, tmp_path):
    """More micro-batches than Spark keeps in memory."""
    root = str(tmp_path)
    spark.range(110).repartition(110).write.option("maxRecordsPerFile", 1).parquet(f"{root}/in")
    stream = files.stream_parquet(spark, f"{root}/in", maxFilesPerTrigger="1")
    with sinks.ProgressLog(spark, f"{root}/log", every=40) as log:
        ran = sinks.append_files(sinks.observed(stream), f"{root}/out", f"{root}/c", name="many")
        log.ended(ran, 300)
    stored = log.read().where("flow = 'many' AND rows_in > 0")
    assert len(ran.recentProgress) <= 100
    assert stored.count() == stored.select("batch").distinct().count() > 100
    assert tuple(stored.agg(F.sum("rows_in"), F.sum("rows_out")).first()) == (110, 110)


def test_windows_open_at_the_end_are_closed(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 'a' AS k, TIMESTAMP_NTZ '2024-01-01 00:05:00' AS ts, 1.0D AS value").write.parquet(f"{root}/in")

    def run():
        rows = sinks.with_closing(files.stream_parquet(spark, f"{root}/in"), f"{root}/closing", "ts")
        sinks.append_files(sinks.windowed_counts(rows, ["k"], "ts", "10 minutes", "1 hour"), f"{root}/out", f"{root}/c").awaitTermination()
        return spark.read.parquet(f"{root}/out")

    assert run().count() == 0
    sinks.close_windows(spark, f"{root}/closing", "ts", "timestamp_ntz", spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS ts"), "1 DAY")
    assert run().count() == 0
    sinks.close_windows(spark, f"{root}/closing", "ts", "timestamp_ntz", spark.read.parquet(f"{root}/in").agg(F.max("ts")), "1 DAY")
    assert [(r.k, r.n) for r in run().collect()] == [("a", 1)]
    # Later rows open new windows; those before the closing time come too late.
    spark.sql("SELECT 'a' AS k, TIMESTAMP_NTZ '2024-01-09 00:05:00' AS ts, 1.0D AS value UNION ALL SELECT 'late', TIMESTAMP_NTZ '2024-01-01 00:05:00', 1.0D").write.mode("append").parquet(f"{root}/in")
    assert run().count() == 1
    sinks.close_windows(spark, f"{root}/closing", "ts", "timestamp_ntz", spark.read.parquet(f"{root}/in").agg(F.max("ts")), "1 DAY")
    assert run().where("k = 'a'").count() == 2
