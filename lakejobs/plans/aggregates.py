"""Aggregations over the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators.ordered import discrete_percentiles
from lakejobs.operators.profile import null_report
from lakejobs.operators.relational import rate_pct, sorted_set, tag_map
from lakejobs.registry import query

MONEY = "decimal(18,2)"


def exact_sum(column: str):
    """Sum of a money column through DECIMAL, so the result does not depend on the row order."""
    return F.sum(F.col(column).cast(MONEY)).cast("double")


@query("agg_global", """
SELECT count(*) AS rows, count(DISTINCT l_partkey) AS parts, count(l_tax) AS taxed, avg(l_linenumber) AS mean_line,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS mean_price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem""")
def agg_global(t):
    return t.lineitem.agg(
        F.count("*").alias("rows"), F.countDistinct("l_partkey").alias("parts"), F.count("l_tax").alias("taxed"),
        F.avg("l_linenumber").alias("mean_line"), F.round(exact_sum("l_extendedprice") / F.count("*"), 2).alias("mean_price"),
        exact_sum("l_quantity").alias("quantity"))


@query("agg_group", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, avg(l_linenumber) AS mean_line
FROM lineitem GROUP BY 1, 2""")
def agg_group(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), exact_sum("l_extendedprice").alias("price"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"), F.avg("l_linenumber").alias("mean_line"))


@query("agg_group_expr", """
SELECT CAST(l_shipdate AS DATE) AS day, left(l_returnflag, 1) AS flag, CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS lot,
       count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")
def agg_group_expr(t):
    return t.lineitem.groupBy(
        F.to_date("l_shipdate").alias("day"), F.left("l_returnflag", F.lit(1)).alias("flag"),
        F.when(F.col("l_quantity") > 25, "big").otherwise("small").alias("lot"),
    ).agg(F.count("*").alias("n"))


@query("agg_group_all", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def agg_group_all(t):
    return t.spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY ALL", orders=t.orders)


@query("agg_conditional", """
SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS large, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS large_sum,
       round(100.0 * count(*) FILTER (value > 50) / CAST(count(*) AS DOUBLE), 2) AS large_pct FROM events GROUP BY 1""")
def agg_conditional(t):
    large = F.col("value") > 50
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(large).alias("large"), F.sum(F.when(large, 1).otherwise(0)).alias("large_sum"),
        rate_pct(F.count_if(large), F.count("*")).alias("large_pct"))


@query("agg_having", views=("run_timeline",), sql="""
SELECT job_id, run_id, count(*) AS n, max(result_state) AS state FROM run_timeline GROUP BY 1, 2
HAVING max(result_state) = 'FAILED' AND count(*) >= 2""")
def agg_having(t):
    return t.run_timeline.groupBy("job_id", "run_id").agg(
        F.count("*").alias("n"), F.max("result_state").alias("state")).where("state = 'FAILED' AND n >= 2")


@query("agg_distinct_sets", """
SELECT user_id, list_sort(list(DISTINCT event_type)) AS types, count(DISTINCT event_type) AS n_types,
       count(DISTINCT CAST(ts AS DATE)) AS n_days FROM events GROUP BY 1""")
def agg_distinct_sets(t):
    return t.events.groupBy("user_id").agg(
        sorted_set("event_type").alias("types"), F.countDistinct("event_type").alias("n_types"),
        F.countDistinct(F.to_date("ts")).alias("n_days"))


@query("agg_concat_list", """
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY 1""")
def agg_concat_list(t):
    return t.nation.groupBy("n_regionkey").agg(
        F.concat_ws(", ", F.array_sort(F.collect_list("n_name"))).alias("nations"))


@query("agg_percentile", """
SELECT event_type, percentile_disc(0.5) WITHIN GROUP (ORDER BY value) AS p50, percentile_disc(0.9) WITHIN GROUP (ORDER BY value) AS p90,
       percentile_disc(0.99) WITHIN GROUP (ORDER BY value) AS p99 FROM events GROUP BY 1""")
def agg_percentile(t):
    """Exact percentiles from counts of equal values."""
    return discrete_percentiles(t.events, ["event_type"], "value", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query("agg_two_level", views=("run_timeline",), sql="""
WITH r AS (SELECT job_id, run_id, CAST(sum(slice_sec) AS BIGINT) AS sec FROM run_timeline GROUP BY 1, 2)
SELECT job_id, count(*) AS runs, max(sec) AS longest, CAST(sum(sec) AS BIGINT) / CAST(count(*) AS DOUBLE) AS mean_sec FROM r GROUP BY 1""")
def agg_two_level(t):
    per_run = t.run_timeline.groupBy("job_id", "run_id").agg(F.sum("slice_sec").alias("sec"))
    return per_run.groupBy("job_id").agg(
        F.count("*").alias("runs"), F.max("sec").alias("longest"), F.avg("sec").alias("mean_sec"))


@query("agg_rounding", """
SELECT l_suppkey, CAST(round_even(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 1) AS DOUBLE) AS price FROM lineitem GROUP BY 1""")
def agg_rounding(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.bround(F.sum(F.col("l_extendedprice").cast(MONEY)), 1).cast("double").alias("price"))


@query("agg_pivot_first", """
WITH kv AS (SELECT user_id, event_type, arg_min(value, (ts, event_id)) AS v FROM events GROUP BY 1, 2)
SELECT user_id, max(v) FILTER (event_type = 'signup') AS signup, max(v) FILTER (event_type = 'click') AS click,
       max(v) FILTER (event_type = 'purchase') AS purchase, max(v) FILTER (event_type = 'view') AS view,
       max(v) FILTER (event_type = 'error') AS error FROM kv GROUP BY 1""")
def agg_pivot_first(t):
    """Key/value rows to columns with the earliest value of each key; values are named, so no extra job finds them."""
    first = F.min_by("value", F.struct("ts", "event_id"))
    return t.events.groupBy("user_id").pivot("event_type", ["signup", "click", "purchase", "view", "error"]).agg(first)


@query("agg_time_bucket", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS bucket, date_trunc('hour', ts) AS hour, count(*) AS n, max(value) AS peak
FROM events GROUP BY 1, 2""")
def agg_time_bucket(t):
    return t.events.groupBy(
        F.window("ts", "5 minutes")["start"].alias("bucket"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    ).agg(F.count("*").alias("n"), F.max("value").alias("peak"))


@query("agg_week_month", """
SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(month(o_orderdate) AS INTEGER) AS month_no, CAST(year(o_orderdate) AS INTEGER) AS year_no, count(*) AS n FROM orders GROUP BY ALL""")
def agg_week_month(t):
    return t.orders.groupBy(
        F.trunc("o_orderdate", "week").alias("week"), F.trunc("o_orderdate", "month").alias("month"),
        F.month("o_orderdate").alias("month_no"), F.year("o_orderdate").alias("year_no"),
    ).agg(F.count("*").alias("n"))


@query("agg_total_plus_detail", """
SELECT 'TOTAL' AS metric, CAST(NULL AS VARCHAR) AS priority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders
UNION ALL SELECT 'BY_PRIORITY', o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY 2""")
def agg_total_plus_detail(t):
    return t.orders.rollup(F.col("o_orderpriority").alias("priority")).agg(
        F.when(F.grouping_id() == 1, "TOTAL").otherwise("BY_PRIORITY").alias("metric"), exact_sum("o_totalprice").alias("spend"))


@query("agg_map_key", views=("usage",), sql="""
SELECT tag_team AS team, count(*) AS n, CAST(sum(usage_quantity) AS DOUBLE) AS quantity FROM usage WHERE tag_team IS NOT NULL GROUP BY 1""")
def agg_map_key(t):
    tagged = t.usage.select(tag_map(team="tag_team", env="tag_env").alias("tags"), "usage_quantity")
    return tagged.where(F.map_contains_key("tags", "team")).groupBy(F.col("tags")["team"].alias("team")).agg(
        F.count("*").alias("n"), F.sum("usage_quantity").cast("double").alias("quantity"))


@query("agg_data_quality", views=("usage",), sql="""
SELECT 'warehouse_id' AS column_name, count(*) AS total_rows, count(*) - count(warehouse_id) AS null_rows, count(warehouse_id) AS non_null_rows,
       round(100.0 * (count(*) - count(warehouse_id)) / CAST(count(*) AS DOUBLE), 2) AS null_pct FROM usage UNION ALL
SELECT 'tag_team', count(*), count(*) - count(tag_team), count(tag_team),
       round(100.0 * (count(*) - count(tag_team)) / CAST(count(*) AS DOUBLE), 2) FROM usage""")
def agg_data_quality(t):
    return null_report(t.usage, ["warehouse_id", "tag_team"])


@query("math_minmax_scale", views=("matches",), sql="""
WITH team AS (SELECT home_team AS team, count(*) AS played, CAST(sum(home_score) AS BIGINT) AS goals, CAST(sum(away_score) AS BIGINT) AS conceded FROM matches GROUP BY 1),
s AS (SELECT team, round(100.0 * (goals - min(goals) OVER ()) / (max(goals) OVER () - min(goals) OVER ()), 2) AS goals_score,
   round(100.0 - 100.0 * (conceded - min(conceded) OVER ()) / (max(conceded) OVER () - min(conceded) OVER ()), 2) AS defence_score FROM team)
SELECT team, goals_score, defence_score, CAST(50.0 AS DOUBLE) AS constant_score, round(0.6 * goals_score + 0.3 * defence_score + 0.1 * 50.0, 2) AS power_index FROM s""")
def math_minmax_scale(t):
    """0-100 scores; the bounds are a one-row aggregate joined to every team."""
    from lakejobs.functions.scoring import minmax_scores

    teams = t.matches.groupBy(F.col("home_team").alias("team")).agg(
        F.sum("home_score").alias("goals"), F.sum("away_score").alias("conceded"), F.lit(1).alias("same"))
    scored = minmax_scores(teams, {"goals": True, "conceded": False, "same": True})
    return scored.select(
        "team", F.col("goals_score"), F.col("conceded_score").alias("defence_score"), F.col("same_score").alias("constant_score"),
        F.round(0.6 * F.col("goals_score") + 0.3 * F.col("conceded_score") + 0.1 * F.col("same_score"), 2).alias("power_index"))
