"""Sliced ordered operators must equal the plain window and plain Python loops."""

from collections import defaultdict

from pyspark.sql import functions as F

from lakejobs.operators.ordered import (
    asof_join, dense_number, newest_list, plan_slices, running_totals, trailing_sums,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_slices_split_a_hot_key(tables):
    hot = tables.events.withColumn("user_id", F.when(F.col("event_id") % 3 > 0, F.lit(7)).otherwise(F.col("user_id")))
    cut = plan_slices(hot, "ts", 100)
    assert len(cut.borders) >= 8
    sizes = [r["count"] for r in cut.assign(hot, ["ts"]).groupBy("user_id", "_slice").count().collect()]
    assert max(sizes) <= 150


def test_running_totals(tables):
    events = tables.events.withColumn("user_id", F.col("user_id") % 3)
    totals = {"n": F.lit(1), "clicks": F.when(F.col("event_type") == "click", 1).otherwise(0)}
    cut = plan_slices(events, "ts", 60)
    assert not cut.single
    sliced = running_totals(events, ["user_id"], ["ts", "event_id"], totals, cut).select("event_id", "n", "clicks")
    whole = running_totals(events, ["user_id"], ["ts", "event_id"], totals).select("event_id", "n", "clicks")
    assert rows(sliced) == rows(whole)
    seen, expected = defaultdict(lambda: [0, 0]), []
    for r in sorted(events.collect(), key=lambda r: (r["ts"], r["event_id"])):
        expected.append((r["event_id"], *seen[r["user_id"]]))
        seen[r["user_id"]][0] += 1
        seen[r["user_id"]][1] += r["event_type"] == "click"
    assert rows(sliced) == sorted(expected, key=repr)


def test_newest_list(tables):
    found = newest_list(tables.events, ["event_type"], ["ts", "event_id"], F.col("event_id"), 3, "ids")
    by_type = defaultdict(list)
    for r in sorted(tables.events.collect(), key=lambda r: (r["ts"], r["event_id"])):
        by_type[r["event_type"]].append(r["event_id"])
    assert {r["event_type"]: list(r["ids"]) for r in found.collect()} == {k: v[-3:] for k, v in by_type.items()}


def test_dense_number(tables):
    numbered = dense_number(tables.orders, ["o_orderkey"], "id", 1000, 5, plan_slices(tables.orders, "o_orderkey", 90))
    ids = [r["id"] for r in numbered.orderBy("o_orderkey").collect()]
    assert ids == list(range(1000, 1000 + 5 * len(ids), 5))


def test_asof_join_slices_and_tolerance(tables):
    left = tables.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = tables.events.where("event_type = 'click'").select(
        F.col("user_id"), F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    for tolerance in (None, 86_400):
        cut = plan_slices(tables.events, "ts", 50)
        sliced = asof_join(left, right, ["user_id"], "ts", "click_ts", ["click_id", "click_ts"], tolerance, slices=cut)
        whole = asof_join(left, right, ["user_id"], "ts", "click_ts", ["click_id", "click_ts"], tolerance)
        assert rows(sliced) == rows(whole)
        assert sliced.count() == left.count()
        assert sliced.where("click_ts > ts").count() == 0
    clicks = [tuple(r) for r in right.collect()]
    expected = []
    for r in left.collect():
        past = [c for c in clicks if c[0] == r["user_id"] and 0 <= (r["ts"] - c[1]).total_seconds() <= 86_400]
        best = max(past, key=lambda c: c[1]) if past else (None, None, None)
        expected.append((r["event_id"], r["user_id"], r["ts"], best[2], best[1]))
    assert rows(sliced) == sorted(expected, key=repr)


def test_trailing_sums(tables):
    events = tables.events.withColumn("user_id", F.col("user_id") % 40).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    cut = plan_slices(events, "ts", 25)
    args = (events, ["user_id"], ["ts", "event_id"], {"n": (F.lit(1), 10), "cents10": (F.col("cents"), 10), "cents3": (F.col("cents"), 3)})
    columns = ("event_id", "n", "cents10", "cents3")
    assert rows(trailing_sums(*args, cut).select(*columns)) == rows(trailing_sums(*args).select(*columns))
    past, expected = defaultdict(list), []
    for r in sorted(events.collect(), key=lambda r: (r["ts"], r["event_id"])):
        own = past[r["user_id"]]
        expected.append((r["event_id"], len(own[-10:]), sum(own[-10:]), sum(own[-3:])))
        own.append(r["cents"])
    assert rows(trailing_sums(*args, cut).select(*columns)) == sorted(expected, key=repr)


def test_hot_order_value_is_cut_by_the_second_column(tables):
    """A third of all rows share one key and one time; no (key, slice) holds them together."""
    hot = F.col("event_id") % 3 == 0
    events = tables.events.withColumns({
        "user_id": F.when(hot, F.lit(7)).otherwise(F.col("user_id") % 5),
        "ts": F.when(hot, F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).otherwise(F.col("ts"))})
    order = ["ts", "event_id"]
    cut = plan_slices(events, order, 40)
    assert len(cut.borders) >= 12
    sizes = [r["count"] for r in cut.assign(events, order).groupBy("user_id", "_slice").count().collect()]
    assert max(sizes) <= 80
    totals = {"n": F.lit(1), "ids": F.col("event_id")}
    pick = ("event_id", "n", "ids")
    assert rows(running_totals(events, ["user_id"], order, totals, cut).select(*pick)) == rows(
        running_totals(events, ["user_id"], order, totals).select(*pick))
    last = {"n": (F.lit(1), 7), "ids": (F.col("event_id"), 4), "same": (F.lit(1), 7, ["ts"])}
    assert rows(trailing_sums(events, ["user_id"], order, last, cut).select(*pick, "same")) == rows(
        trailing_sums(events, ["user_id"], order, last).select(*pick, "same"))
    one, many = dense_number(events, order, "id"), dense_number(events, order, "id", slices=cut)
    assert rows(one.select("event_id", "id")) == rows(many.select("event_id", "id"))


def test_nulls_and_strings_stay_in_every_slicing(tables, spark):
    """NULL keys, NULL times and string order columns give equal rows under one, few and many slices."""
    base = tables.events.withColumns({
        "user_id": F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("user_id") % 3),
        "ts": F.when(F.col("event_id") % 4 == 0, None).when(F.col("event_id") % 3 == 0, F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
        .otherwise(F.col("ts")),
        "name": F.when(F.col("event_id") % 7 == 0, None).otherwise(F.concat("event_type", F.lpad(F.col("event_id").cast("string"), 6, "0")))})
    totals = {"n": F.lit(1), "ids": F.col("event_id")}
    last = {"n": (F.lit(1), 7), "ids": (F.col("event_id"), 4)}
    right = base.select("user_id", F.col("ts").alias("r_ts"), F.col("event_id").alias("r_id"))
    for order in (["ts", "name", "event_id"], ["name", "event_id"]):
        whole = running_totals(base, ["user_id"], order, totals).select("event_id", "n", "ids")
        sums = trailing_sums(base, ["user_id"], order, last).select("event_id", "n", "ids")
        numbers = dense_number(base, order, "id").select("event_id", "id")
        count = base.count()
        for size in (count // 3, count // 40):
            cut = plan_slices(base, order, size)
            assert len(cut.borders) >= 2
            assert max(r["count"] for r in cut.assign(base, order).groupBy("_slice").count().collect()) <= 2 * size + 20
            assert rows(running_totals(base, ["user_id"], order, totals, cut).select("event_id", "n", "ids")) == rows(whole)
            assert rows(trailing_sums(base, ["user_id"], order, last, cut).select("event_id", "n", "ids")) == rows(sums)
            assert rows(dense_number(base, order, "id", slices=cut).select("event_id", "id")) == rows(numbers)
        assert len(rows(whole)) == len(rows(numbers)) == count
    joined = asof_join(base, right, ["user_id"], "ts", "r_ts", ["r_id"], tie_break=["r_id"])
    sliced = asof_join(base, right, ["user_id"], "ts", "r_ts", ["r_id"], tie_break=["r_id"], slices=plan_slices(base, "ts", 50))
    assert rows(joined) == rows(sliced) and joined.count() == base.count()
    assert joined.where("(user_id IS NULL OR ts IS NULL) AND r_id IS NOT NULL").count() == 0


def test_trailing_sums_with_totals_over_nulls_and_small_batches(spark):
    """Arrow batches of three rows, NULL keys, values and days: equal to windows, in one slice and in many."""
    from pyspark.sql import Window

    made = [(None if i % 7 == 0 else i % 3, None if i % 5 == 0 else i // 4, i, None if i % 4 == 1 else i * 1.5, i % 6) for i in range(120)]
    frame = spark.createDataFrame(made, "k int, day int, id int, x double, n int")
    w = Window.partitionBy("k").orderBy("day", "id")
    same = Window.partitionBy("k", "day").orderBy("day", "id")

    def zero(c):
        return F.coalesce(c, F.lit(0))

    expected = rows(frame.select(
        "id", zero(F.sum("x").over(w.rowsBetween(-4, -1))).alias("x4"), zero(F.sum("n").over(w.rowsBetween(-2, -1))).alias("n2"),
        zero(F.sum("x").over(same.rowsBetween(-4, -1))).alias("same"),
        zero(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1))).alias("all")))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for cut in (None, plan_slices(frame, ["day", "id"], 15)):
            x = F.col("x")
            got = trailing_sums(frame, ["k"], ["day", "id"], {"x4": (x, 4), "n2": (F.col("n"), 2), "same": (x, 4, ["day"])},
                                cut, {"all": F.col("n")}, ["id"])
            assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
            assert rows(got.select("id", "x4", "n2", "same", "all")) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_hierarchy_levels_hand_on_no_inferred_filters(spark):
    """A parent that is an expression of the node must not put a longer filter on the edges with every level."""
    from lakejobs.operators.hierarchy import closure

    nodes = spark.range(1100).select("id", F.when(F.col("id") > 0, F.expr("id div 4")).alias("up"), F.concat(F.lit("n"), "id").alias("name"))
    found = closure(nodes, "id", "up", "name")
    levels = found._jdf.queryExecution().optimizedPlan()
    assert max(len(levels.children().apply(i).constraints().toString()) for i in range(levels.children().size())) < 1000
    got = {r["node_id"]: (r["ancestor_id"], r["parent_id"], r["node_path"], r["depth"]) for r in found.collect()}
    for n in range(1100):
        path = [n]
        while path[0]:
            path.insert(0, path[0] // 4)
        assert got[n] == (0, n // 4 if n else None, [f"n{i}" for i in path], len(path) - 1)
    assert len(got) == 1100
