"""Merge family, change feed, versions, schema changes, keys and layout."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakejobs.operators import layout
from lakejobs.operators.keys import identity_assign, with_generated
from lakejobs.operators.merge import (
    INSERT_ONLY, UPSERT, Matched, MergePlan, NotMatched, apply_changes, changed, delete_where, insert_only, merge,
    merge_actions, merge_metrics, merge_partitions, table_changes, update_where,
)
from lakejobs.operators.ordered import plan_slices
from lakejobs.operators.versions import ChangeRefused, VersionedTable, allowed_widening


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0), (2, "b", 20.0), (3, None, 30.0)], "id long, name string, balance double")


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([(2, "b2", 5.0), (3, "c", 0.0), (9, "z", 1.0)], "id long, name string, balance double")


@pytest.mark.parametrize("small", [False, True])
def test_upsert_twice_is_once(accounts, incoming, small):
    once = merge(accounts, incoming, ["id"], UPSERT, small)
    assert rows(once) == [(1, "a", 10.0), (2, "b2", 5.0), (3, "c", 0.0), (9, "z", 1.0)]
    assert rows(merge(once, incoming, ["id"], UPSERT, small)) == rows(once)


def test_small_source_plan_keeps_the_target_in_place(accounts, incoming):
    plan = merge(accounts, incoming, ["id"], UPSERT, True)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


@pytest.mark.parametrize("small", [False, True])
def test_clause_order_conditions_and_delete(accounts, incoming, small):
    plan = MergePlan(
        (Matched(delete=True, condition=F.col("s.balance") == 0), Matched({"balance": F.col("t.balance") + F.col("s.balance")})),
        (NotMatched({"id": F.col("s.id"), "name": F.lit("new")}, F.col("s.id") > 5),),
    )
    actions = merge_actions(accounts, incoming, ["id"], plan, small)
    assert rows(merge(accounts, incoming, ["id"], plan, small)) == [(1, "a", 10.0), (2, "b", 25.0), (9, "new", None)]
    assert dict(rows(merge_metrics(actions))) == {"keep": 1, "update": 1, "delete": 1, "insert": 1}


def test_changed_is_null_safe(accounts, incoming):
    plan = MergePlan((Matched(condition=changed(["name"])),))
    assert (3, "c", 0.0) in rows(merge(accounts, incoming, ["id"], plan))


def test_duplicate_source_keys_fail(accounts, incoming):
    with pytest.raises(Exception, match="duplicate merge key"):
        merge(accounts, incoming.unionAll(incoming), ["id"]).collect()


def test_insert_only(accounts, incoming):
    expected = rows(accounts) + [(9, "z", 1.0)]
    assert rows(insert_only(accounts, incoming, ["id"])) == expected
    assert rows(merge(accounts, incoming, ["id"], INSERT_ONLY)) == expected


def test_update_and_delete_keep_null_conditions(accounts):
    assert rows(update_where(accounts, F.col("name") == "a", {"balance": F.lit(0)}))[0] == (1, "a", 0.0)
    assert (3, None, 30.0) in rows(delete_where(accounts, F.col("name") == "a"))


def test_change_feed_replays(accounts, incoming):
    after = delete_where(merge(accounts, incoming, ["id"]), F.col("id") == 1)
    feed = table_changes(accounts, after, ["id"])
    assert {r[-1] for r in rows(feed)} == {"insert", "delete", "update_pre", "update_post"}
    assert rows(apply_changes(accounts, feed, ["id"])) == rows(after)


def test_versions(spark, accounts, incoming, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(accounts, {"column_mapping": True})
    assert table.commit(merge(table.read(), incoming, ["id"]), "MERGE") == 1
    assert table.read(0).count() == 3 and table.read().count() == 4
    assert table.restore(0) == 2
    assert rows(table.read()) == rows(accounts)
    assert [r["operation"] for r in table.history().collect()] == ["RESTORE", "MERGE", "CREATE"]
    table.rename_column("name", "holder")
    table.drop_column("balance")
    table.add_column("tier", "string", "basic")
    assert table.read().columns == ["id", "holder", "tier"]
    assert {r["tier"] for r in table.read().collect()} == {"basic"}
    assert table.read(1).columns == ["id", "name", "balance"]
    deep, shallow = table.clone_deep(str(tmp_path / "d")), table.clone_shallow(str(tmp_path / "s"))
    assert rows(deep.read()) == rows(shallow.read()) == rows(table.read())
    assert table.detail().first()["row_count"] == 3
    assert table.vacuum_plan(1).count() == 0
    dropped = {r["path"].split("/")[-2] for r in table.vacuum_plan(0).collect()}
    assert dropped == {"v=1"}
    with pytest.raises(ChangeRefused):
        table.vacuum_plan(1000)


def test_refused_changes(spark, accounts, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(accounts)
    for change in (lambda: table.rename_column("name", "n"), lambda: table.drop_column("name"),
                   lambda: table.widen_column("id", "double"), lambda: table.add_column("id", "int")):
        with pytest.raises(ChangeRefused):
            change()
    table.set_properties(append_only=True)
    with pytest.raises(ChangeRefused):
        table.commit(delete_where(table.read(), F.col("id") == 1), "DELETE")
    table.append(accounts)
    assert table.read().count() == 6


def test_widening(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([(1, 20)], "sensor int, temperature int"), {"type_widening": True})
    table.widen_column("temperature", "bigint")
    table.append(spark.createDataFrame([(2, 5_000_000_000)], "sensor int, temperature bigint"))
    assert rows(table.read()) == [(1, 20), (2, 5_000_000_000)]
    with pytest.raises(ChangeRefused):
        table.widen_column("temperature", "int")
    assert not allowed_widening("float", "bigint") and allowed_widening("decimal(10,2)", "decimal(16,5)")
    assert not allowed_widening("decimal(10,2)", "decimal(10,4)")


def test_generated_and_identity(spark):
    sales = spark.createDataFrame([(1, Decimal("100.00"))], "id int, base decimal(10,2)")
    assert with_generated(sales, {"tax": F.col("base") * 2}).first()["tax"] == Decimal("200.00")
    with pytest.raises(ValueError):
        with_generated(sales, {"base": F.lit(1)})
    with pytest.raises(ValueError):
        identity_assign(sales, ["base"], "id")
    base = spark.range(100).withColumnRenamed("id", "k")
    first = identity_assign(base, ["k"], "id", 1000, 10, slices=plan_slices(base, "k", 13))
    assert [r["id"] for r in first.orderBy("k").collect()] == list(range(1000, 2000, 10))
    more = identity_assign(spark.createDataFrame([(500,), (600,)], "k long"), ["k"], "id", 1000, 10, existing=first)
    assert rows(more) == [(500, 2000), (600, 2010)]
    mixed = spark.createDataFrame([(1, 77), (2, None)], "k long, id long")
    assert rows(identity_assign(mixed, ["k"], "id", by_default=True)) == [(1, 77), (2, 1)]


def test_layouts_keep_rows_and_cluster(tables, tmp_path):
    orders = tables.orders
    path = str(tmp_path / "z")
    layout.zorder(orders, ["o_custkey", "o_orderdate"], 8).write.option("compression", "zstd").parquet(path)
    back = orders.sparkSession.read.parquet(path)
    assert rows(back) == rows(orders)
    spread = back.groupBy(F.input_file_name()).agg((F.max("o_custkey") - F.min("o_custkey")).alias("w")).agg(F.avg("w")).first()[0]
    assert spread < 110  # a random spread over files is about 149
    clustered = str(tmp_path / "c")
    layout.cluster(orders, ["o_orderdate"], 4).write.parquet(clustered)
    ranges = orders.sparkSession.read.parquet(clustered).groupBy(F.input_file_name()).agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).orderBy("a").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(ranges, ranges[1:]))
    stats = layout.file_stats(orders.sparkSession.read.parquet(clustered)).collect()
    assert sum(r["row_count"] for r in stats) == orders.count()
    assert layout.compact(back, 10_000).rdd.getNumPartitions() == 1
    with pytest.raises(ValueError):
        layout.cluster(orders, ["a", "b", "c", "d", "e"], 2)


def test_partition_pruning_and_dynamic_overwrite(spark, tables, tmp_path):
    path = str(tmp_path / "p")
    tables.orders.withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").parquet(path)
    plan = spark.read.parquet(path).where("status = 'F'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan
    before = spark.read.parquet(path).where("status = 'O'").count()
    fresh = tables.orders.where("o_orderstatus = 'F'").limit(3).withColumn("status", F.lit("F"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("status").parquet(path)
    assert spark.read.parquet(path).where("status = 'F'").count() == 3
    assert spark.read.parquet(path).where("status = 'O'").count() == before


def test_merge_rewrites_only_touched_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "p")
    base = tables.orders.withColumn("year", F.year("o_orderdate"))
    base.write.partitionBy("year").parquet(path)
    change = base.where("year = 1996 AND o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(1.0))
    moved = base.where("year = 1998").limit(2).withColumn("year", F.lit(2001))
    fresh = base.where("year = 1999").limit(2).withColumns({"o_orderkey": F.col("o_orderkey") + 10_000_000, "year": F.lit(2030)})
    root = str(tmp_path / "s")
    change.unionByName(moved).unionByName(fresh).write.parquet(root)
    source = spark.read.parquet(root)
    expected = rows(merge(spark.read.parquet(path), source, ["o_orderkey"]))
    files = {r[0] for r in spark.read.parquet(path).where("year IN (1995, 1997, 1999, 2000)").select(F.input_file_name()).distinct().collect()}
    assert merge_partitions(spark, path, source, ["o_orderkey"], "year") == 4
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == expected
    kept = {r[0] for r in spark.read.parquet(path).where("year IN (1995, 1997, 1999, 2000)").select(F.input_file_name()).distinct().collect()}
    assert kept == files


def test_merge_partitions_removes_emptied_ones(spark, tmp_path):
    path, root = str(tmp_path / "p"), str(tmp_path / "s")
    spark.createDataFrame([(1, "a", "x y"), (2, "b", "z"), (3, "c", None)], "id long, v string, day string").write.partitionBy("day").parquet(path)
    spark.createDataFrame([(1, "a2", "z"), (3, "c2", "z")], "id long, v string, day string").write.parquet(root)
    merge_partitions(spark, path, spark.read.parquet(root), ["id"], "day")
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == [(1, "a2", "z"), (2, "b", "z"), (3, "c2", "z")]


def test_null_keys_are_inserted_not_refused(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    source = spark.createDataFrame([(1, "x"), (None, "y"), (None, "y"), (2, "z")], "id long, v string")
    for small in (False, True):
        assert rows(merge(target, source, ["id"], small_source=small)) == sorted(
            [(1, "x"), (None, "b"), (None, "y"), (None, "y"), (2, "z")], key=repr)


def test_monotonic_ids_with_an_empty_first_partition(spark, tmp_path):
    import __spark_entry__ as entry_module

    spark.read.parquet("/root/testdata/sf0.01/orders.parquet").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # several splits of a file with one row group
    try:
        ids = spark.read.parquet(f"{tmp_path}/orders.parquet").selectExpr("monotonically_increasing_id() AS i").agg({"i": "min"}).first()[0]
        row = entry_module.queries()["monotonic_id"](spark, str(tmp_path)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids > 0
    assert (row["rows"], row["ids"], row["from_zero"]) == (15000, 15000, True)
