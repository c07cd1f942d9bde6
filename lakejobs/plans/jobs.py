"""Pipeline rules and logs, SQL scripts and functions, hierarchies, access and inventory queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions.strings import mask_email
from lakejobs.operators.access import apply_masks, apply_row_filter
from lakejobs.operators.chunks import date_table, folded_sum, run_chunks
from lakejobs.operators.hierarchy import closure
from lakejobs.operators.relational import has_columns, tag_map
from lakejobs.registry import query
from lakejobs.session import ensure_checkpoint_dir
from lakejobs.streaming.rules import expect_warn, rule_report

# --- rules and logs -------------------------------------------------------------


def event_rules():
    return {"has_value": F.col("value") > 1, "known_type": F.col("event_type") != "error", "early": F.hour("ts") < 20}


RULES_SQL = """
SELECT 'events' AS dataset, 'has_value' AS rule, count(*) FILTER (value > 1) AS passed, count(*) FILTER (NOT value > 1) AS failed FROM events UNION ALL
SELECT 'events', 'known_type', count(*) FILTER (event_type <> 'error'), count(*) FILTER (event_type = 'error') FROM events UNION ALL
SELECT 'events', 'early', count(*) FILTER (hour(ts) < 20), count(*) FILTER (hour(ts) >= 20) FROM events"""


@query("expect_warn", "SELECT * FROM events")
def warn(t):
    """All rows are kept; the counts travel as observed metrics."""
    return expect_warn(t.events, "events_rules", event_rules())


@query("expect_warn_counts", """
SELECT (SELECT count(*) FROM events) AS rows, count(*) FILTER (value > 1) AS has_value_passed, count(*) FILTER (NOT value > 1) AS has_value_failed,
       count(*) FILTER (event_type <> 'error') AS known_type_passed, count(*) FILTER (event_type = 'error') AS known_type_failed,
       count(*) FILTER (hour(ts) < 20) AS early_passed, count(*) FILTER (hour(ts) >= 20) AS early_failed FROM events""")
def expect_warn_counts(t):
    """The counts that a job observes while it writes all rows."""
    seen = Observation("events_rules")
    expect_warn(t.events, "events_rules", event_rules(), seen).write.format("noop").mode("overwrite").save()
    counts = seen.get
    return t.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


@query("validate_columns", """
SELECT 'events' AS table_name, 'event_id, ts' AS required, true AS valid, count(*) AS rows FROM events UNION ALL
SELECT 'events', 'event_id, absent', false, NULL FROM events WHERE event_id = (SELECT min(event_id) FROM events) UNION ALL
SELECT 'orders', '', true, count(*) FROM orders""")
def validate_columns(t):
    """Rows of the tables that have the columns a job asks for; a table without one is reported and not read."""
    found = None
    for name, frame, required in (("events", t.events, ["event_id", "ts"]), ("events", t.events, ["event_id", "absent"]), ("orders", t.orders, [])):
        valid = has_columns(frame, required)
        rows = frame.agg(F.count("*").alias("rows")) if valid else t.spark.createDataFrame([(None,)], "rows long")
        row = rows.select(F.lit(name).alias("table_name"), F.lit(", ".join(required)).alias("required"), F.lit(valid).alias("valid"), "rows")
        found = row if found is None else found.unionAll(row)
    return found


@query("expect_report", RULES_SQL)
def expect_report(t):
    return rule_report(t.events, "events", event_rules())


def event_log(t):
    """Pipeline log rows with a JSON body, derived from the lineage edges."""
    body = F.to_json(F.struct(F.struct(
        F.col("target_table_full_name").alias("output_dataset"), F.array("source_table_full_name").alias("input_datasets"),
    ).alias("flow_definition"), F.struct(F.col("entity_type").alias("action"), F.col("created_by").alias("user_id")).alias("user_action")))
    return t.table_lineage.select(
        F.when(F.col("entity_type") == "JOB", "user_action").otherwise("flow_definition").alias("event_type"), "event_time",
        (F.year("event_time")).alias("update_id"), body.alias("details"))


@query("flow_lineage", views=("table_lineage",), sql="""
WITH newest AS (SELECT max(year(event_time)) AS y FROM table_lineage)
SELECT DISTINCT target_table_full_name AS output_dataset, source_table_full_name AS input_dataset FROM table_lineage, newest
WHERE entity_type <> 'JOB' AND year(event_time) = y AND target_table_full_name IS NOT NULL AND source_table_full_name IS NOT NULL""")
def flow_lineage(t):
    """Input and output datasets of the newest update, read from the JSON bodies."""
    log = event_log(t)
    newest = log.select(F.max("update_id")).scalar()
    flows = log.where((F.col("event_type") == "flow_definition") & (F.col("update_id") == newest))
    inputs = F.from_json(F.get_json_object("details", "$.flow_definition.input_datasets"), "array<string>")
    return flows.select(
        F.get_json_object("details", "$.flow_definition.output_dataset").alias("output_dataset"), F.explode(inputs).alias("input_dataset")
    ).dropna().distinct()


@query("flow_user_actions", views=("table_lineage",), sql="""
SELECT event_time, 'JOB' AS action, created_by AS user_id FROM table_lineage WHERE entity_type = 'JOB'""")
def flow_user_actions(t):
    return event_log(t).where("event_type = 'user_action'").select(
        "event_time", F.get_json_object("details", "$.user_action.action").alias("action"),
        F.get_json_object("details", "$.user_action.user_id").cast("long").alias("user_id"))


@query("materialized_refresh", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def materialized_refresh(t):
    return daily_totals(t.events)


def daily_totals(events):
    return events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


# --- functions -------------------------------------------------------------------


@query("udf_scalar", """
SELECT event_id, dayofweek(ts) IN (0, 6) AS is_weekend, strftime(ts, '%Y-%m') AS partition_id, sqrt(value) + 3 AS shifted FROM events""")
def udf_scalar(t):
    """Two functions as expressions; the third as an Arrow UDF, the form for logic Spark lacks."""

    @F.pandas_udf(T.DoubleType())
    def shifted(v):
        return v.pow(0.5).where(v >= 0) + 3

    return t.events.select(
        "event_id", F.dayofweek("ts").isin(1, 7).alias("is_weekend"), F.date_format("ts", "yyyy-MM").alias("partition_id"),
        shifted("value").alias("shifted"))


@query("udf_sql_scalar", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')")
def udf_sql_scalar(t):
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION may_see(segment STRING, extra STRING DEFAULT 'HOUSEHOLD')
                   RETURNS BOOLEAN RETURN segment = 'BUILDING' OR segment = extra""")
    return t.customer.where(F.expr("may_see(c_mktsegment)")).select("c_custkey", "c_mktsegment")


OPEN_SQL = """
SELECT {tag} AS asked, r_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'O' {cond} GROUP BY 1, 2"""


@query("udtf_sql", OPEN_SQL.format(tag="'some'", cond="AND r_name IN ('ASIA', 'EUROPE')") + " UNION ALL " + OPEN_SQL.format(tag="'all'", cond=""))
def udtf_sql(t):
    """SQL table function whose array argument defaults to NULL, which means all regions."""
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    placed.select("o_orderstatus", "r_name").createOrReplaceTempView("lakejobs_placed_orders")
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION open_orders(regions ARRAY<STRING> DEFAULT NULL)
        RETURNS TABLE (r_name STRING, orders BIGINT) RETURN SELECT r_name, count(*) FROM lakejobs_placed_orders
        WHERE o_orderstatus = 'O' AND (regions IS NULL OR array_contains(regions, r_name)) GROUP BY r_name""")
    return t.spark.sql("""SELECT 'some' AS asked, * FROM open_orders(array('ASIA', 'EUROPE'))
                          UNION ALL SELECT 'all', * FROM open_orders()""")


# --- scripts ----------------------------------------------------------------------


@query("script_vars", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9::DOUBLE FROM orders) AND o_orderstatus = 'O'""")
def script_vars(t):
    """Session variables: one set from a query, one struct, both used in a WHERE."""
    t.orders.createOrReplaceTempView("lakejobs_orders")
    for statement in (
        "DECLARE OR REPLACE VARIABLE high_price DOUBLE DEFAULT 0",
        "DECLARE OR REPLACE VARIABLE choice = named_struct('status', 'O', 'level', 1)",
        "SET VARIABLE high_price = (SELECT max(o_totalprice) * 0.9D FROM lakejobs_orders)",
    ):
        t.spark.sql(statement)
    return t.spark.sql(
        "SELECT o_orderkey, o_totalprice FROM lakejobs_orders WHERE o_totalprice > high_price AND o_orderstatus = choice.status")


@query("script_params", "SELECT o_orderpriority AS k, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def script_params(t):
    """Table and column names as parameters, text run by EXECUTE IMMEDIATE."""
    t.orders.createOrReplaceTempView("lakejobs_orders")
    return t.spark.sql("""
        EXECUTE IMMEDIATE 'SELECT IDENTIFIER(:col) AS k, count(*) AS n FROM IDENTIFIER(:tab) WHERE o_totalprice > :least GROUP BY 1'
        USING 'o_orderpriority' AS col, 'lakejobs_orders' AS tab, 100000 AS least""")


@query("script_blocks", """
SELECT CAST(sum(CASE WHEN o_orderkey % 5 < 3 THEN 1 ELSE 0 END) AS BIGINT) AS total, CAST(3 AS INTEGER) AS steps,
       (SELECT CAST(sum(r_regionkey) AS BIGINT) FROM region WHERE r_regionkey <> 2) AS keys FROM orders""")
def script_blocks(t):
    """Compound statement: WHILE with LEAVE, FOR over a query with ITERATE, IF, REPEAT."""
    t.orders.createOrReplaceTempView("lakejobs_orders")
    t.region.createOrReplaceTempView("lakejobs_region")
    return t.spark.sql("""
        BEGIN
          DECLARE step INT DEFAULT 0;
          DECLARE total BIGINT DEFAULT 0;
          DECLARE keys BIGINT DEFAULT 0;
          outer_loop: WHILE TRUE DO
            IF step >= 3 THEN LEAVE outer_loop; END IF;
            SET total = total + (SELECT count(*) FROM lakejobs_orders WHERE o_orderkey % 5 = step);
            SET step = step + 1;
          END WHILE outer_loop;
          each_region: FOR r AS SELECT r_regionkey FROM lakejobs_region DO
            IF r.r_regionkey = 2 THEN ITERATE each_region; END IF;
            SET keys = keys + r.r_regionkey;
          END FOR each_region;
          SELECT total, step AS steps, keys;
        END""")


@query("script_row_count", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS step, count(*) AS rows_written FROM orders GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM orders""")
def script_row_count(t):
    """Rows per step and in total (the NULL step), from one pass."""
    return t.orders.rollup(F.year("o_orderdate").alias("step")).agg(F.count("*").alias("rows_written"))


@query("hierarchy_closure", """
WITH RECURSIVE edge AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN c_custkey // 4 END AS up, c_name AS name FROM customer),
tree AS (SELECT id AS ancestor_id, up AS parent_id, id AS node_id, [name] AS node_path, 0 AS depth FROM edge WHERE up IS NULL
  UNION ALL SELECT t.ancestor_id, e.up, e.id, list_append(t.node_path, e.name), t.depth + 1 FROM tree t JOIN edge e ON e.up = t.node_id)
SELECT *, node_path[2] AS lvl_1, node_path[3] AS lvl_2, node_path[4] AS lvl_3 FROM tree""")
def hierarchy_closure(t):
    edges = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") > 0, F.expr("c_custkey div 4")).alias("parent"), "c_name")
    tree = closure(edges, "c_custkey", "parent", "c_name")
    return tree.select("*", *[F.get("node_path", F.lit(i)).alias(f"lvl_{i}") for i in (1, 2, 3)]).orderBy("node_path")


CHUNK_STEPS = 10_000
CHUNK_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey % 10 AS store, count(l_orderkey) AS orders, count(l_partkey) AS parts,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + i) AS DOUBLE) AS cost
FROM lineitem, (SELECT unnest(range({CHUNK_STEPS})) AS i) WHERE day(l_shipdate) = 15 GROUP BY 1, 2"""


def chunk_days(t):
    """Days of the shipments that are the 15th of a month, from a date table."""
    span = t.lineitem.agg(F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))
    return date_table(span, "first", "last").where("d_dom = 15").select(F.col("d_date").alias("day"))


def chunk_totals(rows):
    """Totals of shipments times every step, by day and store."""
    cost = F.col("l_extendedprice").cast("decimal(18,2)")
    return rows.groupBy("day", (F.col("l_suppkey") % 10).alias("store")).agg(
        (F.count("l_orderkey") * CHUNK_STEPS).alias("orders"), (F.count("l_partkey") * CHUNK_STEPS).alias("parts"),
        folded_sum(cost, CHUNK_STEPS).cast("double").alias("cost"))


@query("chunked_aggregate", CHUNK_SQL)
def chunked_aggregate(t):
    """A sum over every row times 0..9999 in one statement: a join with the date table, the steps folded."""
    return chunk_totals(t.lineitem.withColumn("day", F.to_date("l_shipdate")).join(chunk_days(t), "day"))


@query("chunked_loop", CHUNK_SQL)
def chunked_loop(t):
    """The same year by year, each an appended partition; the first run dies on the way and the second takes it up."""
    path = f"{ensure_checkpoint_dir(t.spark)}/chunks-{uuid.uuid4().hex}"
    days = chunk_days(t).withColumn("year", F.year("day"))
    shipped, years = t.lineitem.withColumn("day", F.to_date("l_shipdate")), days.select("year").distinct()

    class Stopped(Exception):
        pass

    def until(last):
        def build(year):
            if year > last:
                raise Stopped
            return chunk_totals(shipped.join(days.where(F.col("year") == year).select("day"), "day")).withColumn("year", F.lit(year))

        return build

    middle, end = years.select(F.percentile_approx("year", 0.5), F.max("year")).first()
    for last in (middle, end):
        try:
            run_chunks(years, until(last), path)
        except Stopped:
            continue
    return t.spark.read.parquet(path).select("day", "store", "orders", "parts", "cost")


@query("json_variable", """
SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS whole_row FROM part""")
def json_variable(t):
    some = t.part.select("p_partkey", "p_name", "p_size")
    return some.select("p_partkey", F.to_json(F.struct("*")).alias("whole_row"))


# --- access and inventory ------------------------------------------------------------


@query("rls_filter", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def rls_filter(t):
    """The principal 'region1' sees customers of its nations."""
    grants = t.nation.select(
        F.concat(F.lit("region"), F.col("n_regionkey").cast("string")).alias("principal"), F.col("n_nationkey").alias("value"))
    return apply_row_filter(t.customer, "c_nationkey", grants, "region1", {"root"}).select("c_custkey", "c_nationkey")


@query("column_mask", views=("audit",), sql="""
SELECT event_id, left(email, 3) || '***@' || split_part(email, '@', 2) AS email, workspace_id FROM audit""")
def column_mask(t):
    """A caller outside the 'pii' group sees masked addresses, but may see workspaces."""
    masks = {"email": ("pii", mask_email("email")), "workspace_id": ("staff", F.lit(None).cast("long"))}
    return apply_masks(t.audit.select("event_id", "email", "workspace_id"), masks, {"staff"})


@query("filtered_views", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 180 AS shifted_date,
       CASE WHEN o_orderstatus = 'P' THEN (['banks', 'retail', 'energy'])[o_orderkey % 3 + 1] ELSE o_orderstatus END AS label FROM orders""")
def filtered_views(t):
    """A view with some columns, shifted dates and a default picked by the row's key."""
    defaults = F.array(F.lit("banks"), F.lit("retail"), F.lit("energy"))
    view = t.orders.select(
        "o_orderkey", F.date_add(F.to_date("o_orderdate"), 180).alias("shifted_date"),
        F.when(F.col("o_orderstatus") == "P", F.get(defaults, (F.col("o_orderkey") % 3).cast("int"))).otherwise(
            F.col("o_orderstatus")).alias("label"))
    view.createOrReplaceTempView("lakejobs_shifted_orders")
    return t.spark.table("lakejobs_shifted_orders")


@query("catalog_sizes")
def catalog_sizes(t):
    """Bytes per table of the data folder from its file listing; file contents are not read."""
    listing = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(t.path).select("path", "length")
    table = F.regexp_extract("path", r"/([^/]+)\.parquet(/[^/]*)?$", 1).alias("table_name")
    return listing.groupBy(table).agg(F.count("*").alias("files"), F.sum("length").alias("size_bytes")).withColumn(
        "size_mb", F.round(F.col("size_bytes") / 1048576.0, 4))


@query("file_stats", "SELECT count(*) AS row_count, true AS all_have_bytes FROM orders")
def file_stats(t):
    """Rows of all files of the orders, and whether each file has bytes; names and sizes depend on the writer."""
    from lakejobs.operators.layout import file_stats as stats

    return stats(t.orders).agg(F.sum("row_count").alias("row_count"), F.min(F.col("file_size") > 0).alias("all_have_bytes"))


@query("catalog_types", views=("catalog_tables",), sql="""
SELECT table_schema, max(CASE WHEN table_catalog = 'main' THEN 'MANAGED' END) AS main_type, count(DISTINCT table_name) AS tables
FROM catalog_tables WHERE table_type = 'MANAGED' GROUP BY 1""")
def catalog_types(t):
    """Key/value properties to columns, with external entries left out."""
    managed = t.catalog_tables.where("table_type = 'MANAGED'")
    types = managed.groupBy("table_schema").pivot("table_catalog", ["main"]).agg(F.first("table_type")).withColumnRenamed(
        "main", "main_type")
    counts = managed.groupBy("table_schema").agg(F.countDistinct("table_name").alias("tables"))
    return types.join(counts, "table_schema")


@query("tag_cost", views=("query_history",), sql="""
SELECT tag_team AS team, tag_project AS project, count(*) AS queries, CAST(sum(total_duration_ms) AS BIGINT) / 1000.0 AS seconds
FROM query_history WHERE tag_team IS NOT NULL GROUP BY 1, 2""")
def tag_cost(t):
    tagged = t.query_history.select(tag_map(team="tag_team", project="tag_project").alias("tags"), "total_duration_ms")
    return tagged.where(F.map_contains_key("tags", "team")).groupBy(
        F.col("tags")["team"].alias("team"), F.col("tags")["project"].alias("project")
    ).agg(F.count("*").alias("queries"), (F.sum("total_duration_ms") / 1000.0).alias("seconds"))


# --- more rules, functions, scripts and policies ------------------------------------------


@query("expect_fail", "SELECT event_id, value FROM events")
def fail(t):
    """All rows pass; a broken rule would stop the job (tested)."""
    from lakejobs.streaming.rules import expect_fail

    return expect_fail(t.events.select("event_id", "value"), {"not_negative": F.col("value") >= 0, "has_id": F.col("event_id") >= 0})


@query("udf_struct", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 AS even FROM events""")
def udf_struct(t):
    """A function that returns a struct, run on Arrow batches."""
    import pandas as pd

    @F.pandas_udf("k long, even boolean")
    def facts(props):
        k = props.str.extract(r"(\d+)")[0].astype("int64")
        return pd.DataFrame({"k": k, "even": k % 2 == 0})

    return t.events.select("event_id", facts("props").alias("f")).select("event_id", "f.*")


@query("script_handler", """
WITH step AS (SELECT o_orderpriority, count(*) AS n, row_number() OVER (ORDER BY o_orderpriority) AS no FROM orders GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS done, 'stopped' AS state FROM step WHERE no < 3""")
def script_handler(t):
    """A step for each priority; the third divides by zero, and the EXIT handler reports the orders of the steps that were done."""
    t.orders.createOrReplaceTempView("lakejobs_orders")
    return t.spark.sql("""
        BEGIN
          DECLARE done BIGINT DEFAULT 0;
          DECLARE ratio DOUBLE DEFAULT 0;
          DECLARE EXIT HANDLER FOR DIVIDE_BY_ZERO BEGIN SELECT done, 'stopped' AS state; END;
          FOR o AS SELECT o_orderpriority, count(*) AS n, row_number() OVER (ORDER BY o_orderpriority) AS no
                   FROM lakejobs_orders GROUP BY o_orderpriority ORDER BY o_orderpriority DO
            IF o.no = 3 THEN SET ratio = 1 / 0; END IF;
            SET done = done + o.n;
          END FOR;
          SELECT done, 'complete' AS state;
        END""")


@query("rls_to_view", """
SELECT 'customer' AS view_name, count(*) AS n FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_nationkey < 5""")
def rls_to_view(t):
    """Row filters of a list of tables turned into views by a loop over the list."""
    from lakejobs.operators.access import filter_views

    names = filter_views(
        t.spark, {"customer": (t.customer, F.col("c_nationkey") < 5), "supplier": (t.supplier, F.col("s_nationkey") < 5)})
    counts = [t.spark.table(n).agg(F.count("*").alias("n")).select(F.lit(n.removesuffix("_filtered")).alias("view_name"), "n") for n in names]
    return counts[0].unionAll(counts[1])


@query("tag_policy", """
SELECT c_custkey, 'Cus***' AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""")
def tag_policy(t):
    """Columns tagged personal are cut, columns tagged financial are hidden from this caller."""
    from lakejobs.operators.access import apply_tag_policy

    tags = {"c_name": {"personal"}, "c_acctbal": {"financial"}, "c_mktsegment": {"public"}}
    rules = {
        "personal": ("pii_readers", lambda c: F.concat(F.left(c, F.lit(3)), F.lit("***"))),
        "financial": ("finance", lambda c: F.lit(None).cast("double")), "public": ("staff", lambda c: F.lit("x"))}
    return apply_tag_policy(
        t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), tags, rules, {"staff"})


@query("sort_collated", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS shown FROM customer")
def sort_collated(t):
    """Order under a case- and accent-insensitive collation (a range shuffle by the collated value)."""
    shown = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", shown.alias("shown")).orderBy(F.collate("shown", "UNICODE_CI_AI"), "c_custkey")


@query("str_collate_compare", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building'")
def str_collate_compare(t):
    """Equality that ignores case, accents and trailing blanks, by collation."""
    shown = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.concat("c_mktsegment", F.lit("  ")))
    return t.customer.where(
        (F.collate(F.rtrim(shown), "UTF8_LCASE") == "Building") & (F.collate(shown, "UNICODE_CI_AI_RTRIM") == "buílding")
    ).select("c_custkey")
