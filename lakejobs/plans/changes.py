"""Table change queries: merges, updates, deletes, change feeds, keys and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators.keys import (
    foreign_key_violations, identity_assign, not_null_violations, primary_key_violations, with_generated,
)
from lakejobs.operators.merge import (
    UPSERT, Matched, MergePlan, NotMatched, changed, delete_where, insert_only, merge, net_changes, table_changes, update_where,
)
from lakejobs.operators.profile import column_stats
from lakejobs.registry import query

# The changes: every fifth order is repriced (every tenth to NULL priority), and a
# tenth of all orders comes again as new orders above the greatest key.
SOURCE_SQL = """src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 10 AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 3)"""
COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_changes(t):
    updates = t.orders.where("o_orderkey % 5 = 0").withColumns({
        "o_totalprice": F.col("o_totalprice") + 10,
        "o_orderpriority": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")),
    })
    fresh = t.orders.where("o_orderkey % 10 = 3").withColumns({
        "o_orderkey": F.col("o_orderkey") + 1_000_000_000, "o_orderstatus": F.lit("N")})
    return updates.unionByName(fresh)


UPSERT_SQL = f"""WITH {SOURCE_SQL}
SELECT * FROM src UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)"""


@query("merge_upsert", UPSERT_SQL)
def merge_upsert(t):
    return merge(t.orders, order_changes(t), ["o_orderkey"], UPSERT)


@query("merge_update_if_changed", UPSERT_SQL)
def merge_update_if_changed(t):
    """Update only rows in which some column differs (NULL-safe), insert the new ones."""
    plan = MergePlan((Matched(condition=changed(COLUMNS)),), (NotMatched(),))
    return merge(t.orders, order_changes(t), ["o_orderkey"], plan)


@query("merge_insert_only", f"""WITH {SOURCE_SQL}
SELECT * FROM orders UNION ALL SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def merge_insert_only(t):
    return insert_only(t.orders, order_changes(t), ["o_orderkey"])


@query("merge_expr", """
WITH d AS (SELECT o_custkey AS c_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal + coalesce(d.amount, 0) AS c_acctbal, c.c_mktsegment FROM customer c LEFT JOIN d USING (c_custkey)""")
def merge_expr(t):
    """Balance plus the sum of the pending amounts."""
    amounts = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount"))
    plan = MergePlan((Matched({"c_acctbal": F.col("t.c_acctbal") + F.col("s.amount")}),))
    return merge(t.customer, amounts, ["c_custkey"], plan)


@query("merge_subset_columns", f"""WITH {SOURCE_SQL}
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, coalesce(s.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority FROM orders o LEFT JOIN src s USING (o_orderkey)
UNION ALL SELECT * FROM src WHERE o_orderkey >= 1000000000""")
def merge_subset_columns(t):
    some = {c: F.col(f"s.{c}") for c in ("o_totalprice", "o_orderpriority")}
    return merge(t.orders, order_changes(t), ["o_orderkey"], MergePlan((Matched(some),), (NotMatched(),)), small_source=True)


FEATURE_SQL = """hourly AS (SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events {where} GROUP BY 1, 2)"""


@query("feature_table_merge", """
WITH a AS (SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
b AS (SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-19 12:30:00' GROUP BY 1, 2)
SELECT * FROM b UNION ALL SELECT a.* FROM a ANTI JOIN b ON a.user_id = b.user_id AND a.hour = b.hour""")
def feature_table_merge(t):
    """Upsert of hourly features on (user, hour)."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")

    def hourly(condition: str):
        return t.events.where(condition).groupBy("user_id", hour).agg(F.count("*").alias("n"))

    stored = hourly("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    return merge(stored, hourly("ts >= TIMESTAMP_NTZ '2024-01-19 12:30:00'"), ["user_id", "hour"])


@query("update_where", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN o_totalprice * 0.9::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders""")
def update(t):
    large = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 200000)
    return update_where(
        t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), large,
        {"o_orderstatus": F.lit("P"), "o_totalprice": F.col("o_totalprice") * 0.9})


@query("delete_where", views=("usage",), sql="SELECT * FROM usage WHERE tag_env IS DISTINCT FROM 'dev'")
def delete(t):
    return delete_where(t.usage, F.col("tag_env") == "dev")


@query("ttl_delete", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY")
def ttl_delete(t):
    return expire(t.events, "ts", "2024-01-31 00:00:00", 10)


def expire(df, column: str, as_of: str, days: int):
    """Rows not older than ``days``; the bound is a literal and reaches the scan."""
    from lakejobs.operators.relational import since

    return df.where(since(column, as_of, days))


@query("ctas_refine", """
WITH silver AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders WHERE o_totalprice > 0 AND o_orderstatus <> 'P')
SELECT year(day)::INT AS year_no, c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM silver JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def ctas_refine(t):
    """Raw to refined to aggregated, one plan."""
    silver = t.orders.where("o_totalprice > 0 AND o_orderstatus <> 'P'").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    gold = silver.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return gold.groupBy(F.year("day").alias("year_no"), "c_mktsegment").agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spend"))


@query("table_changes", f"""WITH {SOURCE_SQL}
SELECT *, 'insert' AS _change_type FROM src WHERE o_orderkey >= 1000000000
UNION ALL SELECT *, 'update_post' FROM src WHERE o_orderkey < 1000000000
UNION ALL SELECT o.*, 'update_pre' FROM orders o SEMI JOIN src USING (o_orderkey)
UNION ALL SELECT *, 'delete' FROM orders WHERE o_orderkey % 7 = 1 AND o_orderkey % 5 <> 0""")
def changes_between(t):
    after = delete_where(
        merge(t.orders, order_changes(t), ["o_orderkey"]),
        (F.col("o_orderkey") % 7 == 1) & (F.col("o_orderkey") % 5 != 0) & (F.col("o_orderkey") < 1_000_000_000))
    return table_changes(t.orders, after, ["o_orderkey"])


@query("concurrent_updates", """
WITH d AS (SELECT o_custkey, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1)
SELECT c_custkey, c_acctbal + coalesce(amount, 0) AS balance, coalesce(cnt, 0) AS changes FROM customer LEFT JOIN d ON o_custkey = c_custkey""")
def concurrent_updates(t):
    """All pending changes of a key summed first, then one merge: none can overwrite another."""
    pending = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("balance"), F.lit(1).cast("long").alias("changes"))
    net = net_changes(pending, ["c_custkey"], ["balance", "changes"])
    accounts = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.lit(0).cast("long").alias("changes"))
    add = {c: F.col(f"t.{c}") + F.col(f"s.{c}").cast(accounts.schema[c].dataType) for c in ("balance", "changes")}
    return merge(accounts, net, ["c_custkey"], MergePlan((Matched(add),)))


@query("generated_columns", """
SELECT p_partkey, p_retailprice, round(p_retailprice * 0.19::DOUBLE, 2) AS tax, round(p_retailprice * 0.19::DOUBLE, 2) + p_retailprice AS gross,
       CASE WHEN p_retailprice < 1000 THEN 'low' WHEN p_retailprice < 1500 THEN 'mid' ELSE 'high' END AS tier FROM part""")
def generated_columns(t):
    price = F.col("p_retailprice")
    base = with_generated(t.part.select("p_partkey", "p_retailprice"), {
        "tax": F.round(price * 0.19, 2),
        "tier": F.when(price < 1000, "low").when(price < 1500, "mid").otherwise("high")})
    return with_generated(base, {"gross": F.col("tax") + F.col("p_retailprice")})


@query("identity_assign", """
SELECT c_custkey, 999 + row_number() OVER (ORDER BY c_custkey) AS customer_id, 'u' || c_custkey || '@example.com' AS email,
       'example.com' AS email_domain FROM customer""")
def identity(t):
    named = t.customer.select("c_custkey", F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"))
    return identity_assign(named, ["c_custkey"], "customer_id", 1000).withColumn(
        "email_domain", F.substring_index("email", "@", -1))


@query("monotonic_id", "SELECT count(*) AS rows, count(*) AS ids, true AS from_zero FROM orders")
def monotonic_id(t):
    """Unique ids without a shuffle: the values depend on the partitioning, their number and start do not.

    The first partition may hold no row (a split without the start of a row group), so the start is that of
    the row numbers inside a partition, the lower 33 bits.
    """
    numbered = t.orders.select("o_orderkey", F.monotonically_increasing_id().alias("row_id"))
    inside = F.col("row_id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.agg(
        F.count("*").alias("rows"), F.countDistinct("row_id").alias("ids"), F.coalesce(F.min(inside) == 0, F.lit(True)).alias("from_zero"))


@query("key_constraints", """
SELECT 'pk_line' AS rule, count(*) AS violations FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'fk_part', count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)""")
def key_constraints(t):
    """Informational keys: how many key values break them."""
    double = primary_key_violations(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("violations"))
    orphan = foreign_key_violations(t.lineitem, ["l_partkey"], t.part.where("p_size > 2"), ["p_partkey"]).agg(
        F.count("*").alias("violations"))
    return double.select(F.lit("pk_line").alias("rule"), "violations").unionAll(
        orphan.select(F.lit("fk_part").alias("rule"), "violations"))


@query("not_null_check", views=("usage",), sql="""
SELECT 'warehouse_id' AS column_name, count(*) AS null_rows FROM usage WHERE warehouse_id IS NULL
UNION ALL SELECT 'tag_team', count(*) FROM usage WHERE tag_team IS NULL""")
def not_null_check(t):
    return not_null_violations(t.usage, ["warehouse_id", "tag_team", "sku_name"])


@query("table_stats", """
SELECT 'p_brand' AS column_name, count(*) AS row_count, count(*) - count(p_brand) AS null_count, count(DISTINCT p_brand) AS ndv, min(p_brand) AS min_value, max(p_brand) AS max_value FROM part
UNION ALL SELECT 'p_size', count(*), count(*) - count(p_size), count(DISTINCT p_size), CAST(min(p_size) AS VARCHAR), CAST(max(p_size) AS VARCHAR) FROM part""")
def table_stats(t):
    """Column statistics; distinct counts are sketches (exact on small domains)."""
    return column_stats(t.part, ["p_brand", "p_size"])


@query("layout_advise", views=("query_history",), sql="""
WITH f AS (SELECT CASE event_id % 4 WHEN 0 THEN 'o_custkey' WHEN 1 THEN 'o_orderdate' WHEN 2 THEN 'o_orderstatus' ELSE 'o_orderdate' END AS column_name FROM events),
n AS (SELECT column_name, count(*) AS filter_count FROM f GROUP BY 1),
d AS (SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) > 100 AS selective FROM orders UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) > 100 FROM orders
      UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) > 100 FROM orders)
SELECT column_name, filter_count, CAST(row_number() OVER (ORDER BY filter_count DESC, column_name) AS BIGINT) AS key_rank FROM n JOIN d USING (column_name) WHERE selective""")
def layout_advise(t):
    """Cluster keys ranked by how often filters name them, without columns of few values."""
    from lakejobs.operators.layout import advise_keys

    names = F.element_at(F.array(*[F.lit(c) for c in ("o_custkey", "o_orderdate", "o_orderstatus", "o_orderdate")]),
                         (F.col("event_id") % 4 + 1).cast("int"))
    filters = t.events.select(names.alias("column_name"))
    return advise_keys(filters, column_stats(t.orders, ["o_custkey", "o_orderdate", "o_orderstatus"]), 4, 100)
