"""Scans, projections, filters, joins, sets and sorts over the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators.intervals import epoch_to_ntz, open_at
from lakejobs.operators.ordered import dense_number
from lakejobs.operators.relational import between_half_open, latest_by, since, union_all_by_name
from lakejobs.operators.families import spread_families
from lakejobs.registry import query

# --- scans and projections ---------------------------------------------------


@query("scan_table", "SELECT * FROM orders")
def scan_table(t):
    return t.orders


@query("scan_inline_values", """
WITH class(code, label) AS (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned'))
SELECT label, count(*) AS n FROM lineitem JOIN class ON l_returnflag = code GROUP BY 1""")
def scan_inline_values(t):
    labels = t.spark.createDataFrame([("A", "accepted"), ("N", "none"), ("R", "returned")], "code string, label string")
    counts = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return counts.join(labels, F.col("l_returnflag") == F.col("code")).select("label", "n")


@query("project_rename", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS account_balance, c_acctbal * 2 AS double_balance
FROM customer""")
def project_rename(t):
    spaced = t.customer.withColumnsRenamed(
        {"c_custkey": "customer id", "c_name": "customer name", "c_acctbal": "account balance"}
    ).drop("c_nationkey", "c_mktsegment")
    return underscore_names(spaced).withColumn("double_balance", F.col("account_balance") * 2)


def underscore_names(df):
    """Spaces in column names become underscores."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns})


@query("derive_column", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax, l_extendedprice + l_tax AS total FROM lineitem")
def derive_column(t):
    return add_derived_column(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax"), "l_extendedprice", "l_tax", "total")


def add_derived_column(df, first: str, second: str, name: str):
    return df.withColumn(name, F.col(first) + F.col(second))


def filter_by_threshold(df, column: str, threshold: float):
    return df.filter(F.col(column) > threshold)


@query("lateral_alias", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
       CASE WHEN l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 THEN 1 ELSE 0 END AS is_large
FROM lineitem""")
def lateral_alias(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("net") * (1 + F.col("l_tax"))).alias("gross"), F.when(F.col("gross") > 50000, 1).otherwise(0).alias("is_large"))


@query("filter_threshold", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def filter_threshold(t):
    return filter_by_threshold(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 250000)


@query("filter_compound", """
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE (p_size BETWEEN 5 AND 30 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') OR p_name LIKE '%ring%')
  AND p_type NOT IN ('PROMO') AND p_name NOT LIKE '%blue%' AND p_retailprice IS NOT NULL AND NOT p_size = 7""")
def filter_compound(t):
    size, name = F.col("p_size"), F.col("p_name")
    return t.part.where(
        ((size.between(5, 30) & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")) | name.like("%ring%"))
        & ~F.col("p_type").isin("PROMO") & ~name.like("%blue%") & F.col("p_retailprice").isNotNull() & ~(size == 7)
    ).select("p_partkey", "p_name", "p_brand", "p_size")


@query("filter_array_param", """
SELECT c_mktsegment, count(*) AS n, 'named' AS variant FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1
UNION ALL SELECT c_mktsegment, count(*), 'all' FROM customer GROUP BY 1""")
def filter_array_param(t):
    return optional_members(t, ["BUILDING", "MACHINERY"], "named").unionByName(optional_members(t, None, "all"))


def optional_members(t, segments: list[str] | None, variant: str):
    """Counts for the named segments; no list means all of them."""
    chosen = None if segments is None else F.array(*[F.lit(s) for s in segments])
    return t.spark.sql(
        """SELECT c_mktsegment, count(*) AS n, :variant AS variant FROM {customer}
           WHERE :segments IS NULL OR array_contains(CAST(:segments AS ARRAY<STRING>), c_mktsegment) GROUP BY c_mktsegment""",
        args={"segments": chosen, "variant": variant}, customer=t.customer)


@query("filter_relative_time", "SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def filter_relative_time(t):
    return t.events.where(since("ts", "2024-01-31 00:00:00", 7)).select("event_id", "ts", "event_type")


@query("filter_time_range", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'""")
def filter_time_range(t):
    return t.events.where(between_half_open("ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00")).select("event_id", "ts")


@query("case_bucket", """
SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS size_class
FROM orders""")
def case_bucket(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.when(price < 100000, "small").when(price < 300000, "medium").otherwise("large").alias("size_class"))


@query("null_defaults", views=("usage",), sql="""
SELECT job_id, coalesce(CAST(warehouse_id AS BIGINT), -1) AS warehouse_id, nullif(tag_env, 'dev') AS non_dev_env,
       CASE WHEN tag_team IS NULL THEN ['none'] ELSE [tag_team] END AS teams FROM usage""")
def null_defaults(t):
    return t.usage.select(
        "job_id", F.coalesce("warehouse_id", F.lit(-1)).cast("long").alias("warehouse_id"),
        F.nullif("tag_env", F.lit("dev")).alias("non_dev_env"),
        F.when(F.col("tag_team").isNull(), F.array(F.lit("none"))).otherwise(F.array("tag_team")).alias("teams"))


@query("filter_exists", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def filter_exists(t):
    finished = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(finished, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("filter_in_subquery", """
SELECT s_suppkey, s_name, (SELECT max(o_orderdate) FROM orders) AS newest_order,
       (SELECT min(l_shipdate) FROM lineitem) AS first_ship
FROM supplier WHERE s_suppkey IN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_discount >= 0.1)""")
def filter_in_subquery(t):
    """IN is a semi join; the scalar subqueries stay subqueries (one row each)."""
    wanted = t.lineitem.where("l_quantity >= 50 AND l_discount >= 0.1").select(F.col("l_suppkey").alias("s_suppkey"))
    newest = t.orders.select(F.max("o_orderdate")).scalar()
    first = t.lineitem.select(F.min("l_shipdate")).scalar()
    return t.supplier.join(wanted, "s_suppkey", "left_semi").select(
        "s_suppkey", "s_name", newest.alias("newest_order"), first.alias("first_ship"))


# --- joins --------------------------------------------------------------------


@query("join_inner", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""")
def join_inner(t):
    return t.orders.where("o_orderstatus = 'O'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice")


@query("join_left_price", views=("usage", "list_prices"), sql="""
WITH p AS (SELECT sku_name, usage_unit, max_by(unit_price, (price_start_day, price_id)) AS unit_price FROM list_prices
           WHERE sku_name <> 'Brand#1' GROUP BY ALL)
SELECT u.sku_name, u.usage_unit, CAST(sum(u.usage_quantity) AS DOUBLE) AS quantity,
       CAST(coalesce(max(p.unit_price), 0) AS DOUBLE) AS unit_price
FROM usage u LEFT JOIN p ON u.sku_name = p.sku_name AND u.usage_unit = p.usage_unit GROUP BY 1, 2""")
def join_left_price(t):
    """Aggregate first, then join: the price side meets one row per sku and unit."""
    prices = latest_by(
        t.list_prices.where("sku_name <> 'Brand#1'"), ["sku_name", "usage_unit"], ["price_start_day", "price_id"],
        ["unit_price"])
    totals = t.usage.groupBy("sku_name", "usage_unit").agg(F.sum("usage_quantity").cast("double").alias("quantity"))
    return totals.join(prices, ["sku_name", "usage_unit"], "left").select(
        "sku_name", "usage_unit", "quantity", F.coalesce("unit_price", F.lit(0)).cast("double").alias("unit_price"))


@query("join_chain_left", """
SELECT o.o_orderkey, c.c_name, n.n_name, e.event_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_regionkey = 1
LEFT JOIN events e ON e.event_id = o.o_orderkey AND e.user_id = o.o_custkey % 150 AND e.event_type = 'view'""")
def join_chain_left(t):
    nations = t.nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    events = t.events.select("event_id", "user_id", "event_type")
    three = (
        (F.col("event_id") == F.col("o_orderkey")) & (F.col("user_id") == F.col("o_custkey") % 150)
        & (F.col("event_type") == "view")
    )
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, "c_nationkey", "left").join(events, three, "left").select("o_orderkey", "c_name", "n_name", "event_id")


@query("join_anti", """
SELECT s_suppkey, s_name FROM supplier LEFT JOIN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R') x
  ON s_suppkey = l_suppkey WHERE l_suppkey IS NULL""")
def join_anti(t):
    heavy = t.lineitem.where("l_quantity = 50 AND l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"))
    return t.supplier.join(heavy, "s_suppkey", "left_anti").select("s_suppkey", "s_name")


@query("join_full_outer", """
WITH a AS (SELECT l_partkey AS k, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
     b AS (SELECT l_partkey AS k, count(*) AS accepted FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS part_key, coalesce(returned, 0) AS returned, coalesce(accepted, 0) AS accepted
FROM a FULL JOIN b ON a.k = b.k""")
def join_full_outer(t):
    def flagged(flag: str, name: str):
        return t.lineitem.where(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("part_key")).agg(
            F.count("*").alias(name))

    return flagged("R", "returned").join(flagged("A", "accepted"), "part_key", "full").fillna(0, ["returned", "accepted"])


@query("join_cast_key", """
SELECT e.user_id, count(*) AS n FROM events e JOIN customer c ON CAST(e.user_id AS VARCHAR) = ltrim(substr(c.c_name, 10), '0') GROUP BY 1""")
def join_cast_key(t):
    numbers = t.customer.select(F.ltrim(F.substring("c_name", 10, 20), F.lit("0")).alias("text_key"))
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.join(numbers, F.col("user_id").cast("string") == F.col("text_key")).select("user_id", "n")


@query("join_like_broadcast", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey AND c_name LIKE concat('%', CAST(r_regionkey AS VARCHAR))""")
def join_like_broadcast(t):
    """Pattern test as residual of an equality join.

    The equality keeps it a hash join; Spark broadcasts the pattern side only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    patterns = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name",
        F.concat(F.lit("%"), F.col("r_regionkey").cast("string")).alias("pattern"))
    return t.customer.join(patterns, "c_nationkey").where(F.expr("c_name LIKE pattern")).select(
        "c_custkey", "n_name", "r_name")


@query("join_range_spine", views=("run_timeline",), sql="""
WITH spine AS (SELECT unnest(generate_series(date_trunc('minute', min(period_start_time)), max(period_start_time + to_seconds(slice_sec)), INTERVAL 1 MINUTE)) AS tick FROM run_timeline)
SELECT tick, count(*) AS open_slices FROM spine JOIN run_timeline
  ON tick >= date_trunc('second', period_start_time)
 AND tick <= date_trunc('second', period_start_time) + to_seconds(slice_sec) GROUP BY 1""")
def join_range_spine(t):
    """Open slices at each full minute of the data's range that has any, by a sweep over both ends of the slices."""
    ends = t.run_timeline.select(
        F.unix_timestamp(F.col("period_start_time").cast("timestamp")).alias("lo"), "slice_sec"
    ).withColumn("hi", F.col("lo") + F.col("slice_sec"))
    first, last = ends.agg(F.min("lo"), F.max("hi")).first()
    spine = t.spark.range(0 if first is None else first - first % 60, 0 if last is None else last + 1, 60).withColumnRenamed("id", "tick")
    return open_at(spine, ends, "tick", "lo", "hi", "open_slices").where("open_slices > 0").select(
        epoch_to_ntz(F.col("tick")).alias("tick"), "open_slices")


@query("join_feature_lookup", """
SELECT doc_id % 1000 AS part_ref, quality, p_size, p_retailprice FROM labels LEFT JOIN part ON p_partkey = doc_id % 1000""")
def join_feature_lookup(t):
    features = t.part.select(F.col("p_partkey").alias("part_ref"), "p_size", "p_retailprice")
    return t.labels.select((F.col("doc_id") % 1000).alias("part_ref"), "quality").join(features, "part_ref", "left")


SPREAD_SQL = """
WITH pick AS (SELECT a.n_name AS c0, b.n_name AS c1, c.n_name AS c2, d.n_name AS c3, e.n_name AS c4,
    row_number() OVER (ORDER BY a.n_name, b.n_name, c.n_name, d.n_name, e.n_name) - 1 AS group_id
  FROM nation a, nation b, nation c, nation d, nation e
  WHERE a.n_regionkey = 0 AND b.n_regionkey = 1 AND c.n_regionkey = 2 AND d.n_regionkey = 3 AND e.n_regionkey = 4)
SELECT group_id, CAST(substr(family, 2) AS INTEGER) AS family, child FROM pick UNPIVOT (child FOR family IN (c0, c1, c2, c3, c4))"""


@query("join_cross_spread", """
SELECT a.n_name AS child_0, b.n_name AS child_1, c.n_name AS child_2, d.n_name AS child_3, e.n_name AS child_4
FROM nation a, nation b, nation c, nation d, nation e
WHERE a.n_regionkey = 0 AND b.n_regionkey = 1 AND c.n_regionkey = 2 AND d.n_regionkey = 3 AND e.n_regionkey = 4""")
def join_cross_spread(t):
    """One child of each of the five families: every combination, decoded from its number."""
    picked = spread_families(t.nation, "n_regionkey", "n_name")
    return picked.groupBy("group_id").agg(*[
        F.max(F.when(F.col("family") == i, F.col("child"))).alias(f"child_{i}") for i in range(5)]).drop("group_id")


@query("dynamic_family_options", SPREAD_SQL)
def dynamic_family_options(t):
    """Every way to choose one child per family, as (group, family, child) rows."""
    return spread_families(t.nation, "n_regionkey", "n_name")


@query("join_lateral_explode", """
SELECT l_orderkey, l_linenumber, l_quantity, unnest(generate_series(1, l_linenumber)) AS piece FROM lineitem""")
def join_lateral_explode(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    pieces = F.explode(F.sequence(F.lit(1).cast("long"), F.col("l_linenumber").cast("long"))).alias("piece")
    return lines.select("*", pieces)


@query("join_parent_child", """
SELECT c.c_custkey AS node_id, p.c_custkey AS parent_id, p.c_name AS parent_name
FROM customer c JOIN customer p ON p.c_custkey = c.c_custkey // 4 WHERE c.c_custkey > 0""")
def join_parent_child(t):
    parents = t.customer.select(F.col("c_custkey").alias("parent_id"), F.col("c_name").alias("parent_name"))
    nodes = t.customer.where("c_custkey > 0").select(
        F.col("c_custkey").alias("node_id"), F.expr("c_custkey div 4").alias("parent_id"))
    return nodes.join(parents, "parent_id").select("node_id", "parent_id", "parent_name")


@query("join_implicit_cross", """
WITH newest AS (SELECT max(ts) AS newest_ts FROM events)
SELECT event_id, user_id FROM events, newest WHERE CAST(ts AS DATE) = CAST(newest_ts AS DATE)""")
def join_implicit_cross(t):
    """Filter by a one-row view: a scalar subquery carries the one value to every task."""
    newest = t.events.select(F.max("ts")).scalar()
    return t.events.where(F.to_date("ts") == F.to_date(newest)).select("event_id", "user_id")


@query("join_union_map", views=("matches",), sql="""
WITH tier AS (SELECT n_nationkey AS team, n_regionkey + 1 AS tier FROM nation WHERE n_nationkey % 4 <> 0)
SELECT match_id, coalesce(h.tier, 5) AS home_tier, coalesce(a.tier, 5) AS away_tier,
       CASE WHEN coalesce(h.tier, 5) = coalesce(a.tier, 5) THEN 1 ELSE 0 END AS same_tier
FROM matches LEFT JOIN tier h ON home_team = h.team LEFT JOIN tier a ON away_team = a.team""")
def join_union_map(t):
    """Lookup of a team attribute for both sides; a team that is not listed gets the default 5."""
    tier = t.nation.where("n_nationkey % 4 <> 0").select("n_nationkey", (F.col("n_regionkey") + 1).alias("tier"))
    home = tier.select(F.col("n_nationkey").alias("home_team"), F.col("tier").alias("home_tier"))
    away = tier.select(F.col("n_nationkey").alias("away_team"), F.col("tier").alias("away_tier"))
    both = t.matches.join(home, "home_team", "left").join(away, "away_team", "left").fillna(5, ["home_tier", "away_tier"])
    return both.select(
        "match_id", "home_tier", "away_tier", (F.col("home_tier") == F.col("away_tier")).cast("int").alias("same_tier"))


# --- ranks, sorts, limits -------------------------------------------------------


@query("win_row_number_latest", views=("list_prices",), sql="""
SELECT sku_name, usage_unit, price_id, CAST(unit_price AS DOUBLE) AS unit_price FROM list_prices
QUALIFY row_number() OVER (PARTITION BY sku_name, usage_unit ORDER BY price_start_day DESC, price_id DESC) = 1""")
def win_row_number_latest(t):
    return latest_by(
        t.list_prices, ["sku_name", "usage_unit"], ["price_start_day", "price_id"], ["price_id", "unit_price"]
    ).withColumn("unit_price", F.col("unit_price").cast("double"))


@query("win_row_number_global", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders")
def win_row_number_global(t):
    return dense_number(t.orders.select("o_orderkey"), ["o_orderkey"], "row_id")


@query("win_rank_position", views=("matches",), sql="""
WITH team AS (SELECT home_team AS team, count(*) AS played, CAST(sum(home_score) AS BIGINT) AS goals FROM matches GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY played DESC, team) AS played_rank, row_number() OVER (ORDER BY goals DESC, team) AS goals_rank FROM team)
SELECT team, played, goals, played_rank, goals_rank, played_rank >= 10 AND goals_rank <= 8 AS is_dark_horse FROM r""")
def win_rank_position(t):
    """Two rankings of the aggregated teams; numbering is sliced, so many teams are no one-task sort."""
    teams = t.matches.groupBy(F.col("home_team").alias("team")).agg(
        F.count("*").alias("played"), F.sum("home_score").alias("goals")
    ).withColumns({"_p": -F.col("played"), "_g": -F.col("goals")})
    ranked = dense_number(dense_number(teams, ["_p", "team"], "played_rank"), ["_g", "team"], "goals_rank")
    return ranked.select(
        "team", "played", "goals", "played_rank", "goals_rank",
        ((F.col("played_rank") >= 10) & (F.col("goals_rank") <= 8)).alias("is_dark_horse"))


@query("sort_multi", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part ORDER BY p_brand, p_size DESC NULLS LAST, p_partkey")
def sort_multi(t):
    return t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice").orderBy(
        F.asc("p_brand"), F.desc_nulls_last("p_size"), "p_partkey")


@query("top_k", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY 1
ORDER BY spend DESC, o_custkey LIMIT 10""")
def top_k(t):
    return t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spend")
    ).orderBy(F.desc("spend"), "o_custkey").limit(10)


@query("limit_plain", "SELECT least(10, count(*)) AS previewed, least(10, count(*)) AS of_the_table FROM orders")
def limit_plain(t):
    """A preview of any ten rows, given as their number and how many of them are rows of the table."""
    preview = t.orders.limit(10).select("o_orderkey")
    known = t.orders.select(F.col("o_orderkey").alias("key")).distinct()
    return preview.join(known, F.col("o_orderkey") == F.col("key"), "left").agg(
        F.count("*").alias("previewed"), F.count("key").alias("of_the_table"))


@query("latest_one", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_one(t):
    newest = F.max_by(F.struct("event_id", "ts", "event_type"), F.struct("ts", "event_id")).alias("r")
    return t.events.agg(newest).select("r.*")


@query("sort_array_key", """
SELECT c_custkey, [c_custkey // 100, c_custkey // 10, c_custkey] AS path FROM customer ORDER BY path""")
def sort_array_key(t):
    path = F.array(F.expr("c_custkey div 100"), F.expr("c_custkey div 10"), "c_custkey").alias("path")
    return t.customer.select("c_custkey", path).orderBy("path")


# --- sets and shapes --------------------------------------------------------------


@query("union_distinct", """
SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer""")
def union_distinct(t):
    return t.orders.select(F.col("o_custkey").alias("id")).union(t.customer.select("c_custkey")).distinct()


@query("union_all", """
SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""")
def union_all(t):
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).union(
        t.customer.select("c_custkey", "c_name"))


@query("union_by_name", """
SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2 UNION ALL
SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""")
def union_by_name(t):
    frames = [
        t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("customer")),
        t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n")).select(
            F.lit("supplier").alias("kind"), "n", "nation"),
    ]
    return union_all_by_name(frames)


@query("select_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def select_distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("unpivot", """
SELECT p_partkey, measure, value FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part)
UNPIVOT (value FOR measure IN (size, price))""")
def unpivot(t):
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")).unpivot(
        ["p_partkey"], ["size", "price"], "measure", "value")


@query("set_difference", "SELECT p_partkey AS id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_difference(t):
    taken = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("id"))
    return t.part.select(F.col("p_partkey").alias("id")).distinct().join(taken, "id", "left_anti")
