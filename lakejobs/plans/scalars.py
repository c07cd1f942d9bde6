"""Scalar function queries: strings, dates, numbers, arrays, maps, JSON and VARIANT."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.functions.semi import shred
from lakejobs.functions.strings import keyword_class, lookup, mask_email, mask_id, part
from lakejobs.operators.intervals import epoch_to_ntz
from lakejobs.operators.relational import rate_pct, tag_map
from lakejobs.registry import query


@query("str_split_index", """
SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level, split_part(o_orderpriority, '-', 2) AS label,
       CAST(NULL AS VARCHAR) AS missing FROM orders""")
def str_split_index(t):
    return t.orders.select(
        "o_orderkey", part("o_orderpriority", "-", 0).try_cast("int").alias("level"), part("o_orderpriority", "-", 1).alias("label"),
        part("o_orderpriority", "-", 9).alias("missing"))


@query("str_basic", """
SELECT p_partkey, left(p_name, 3) AS head, right(p_name, 3) AS tail, upper(p_type) AS type_upper, lower(p_brand) AS brand_lower,
       length(p_name) AS name_length, p_name || '/' || p_brand AS joined, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS padded,
       repeat('*', p_size % 4) AS stars, replace(p_name, ' ', '_') AS snake, split_part(p_brand, '#', 1) AS brand_word FROM part""")
def str_basic(t):
    return t.part.select(
        "p_partkey", F.left("p_name", F.lit(3)).alias("head"), F.right("p_name", F.lit(3)).alias("tail"),
        F.upper("p_type").alias("type_upper"), F.lower("p_brand").alias("brand_lower"),
        F.length("p_name").cast("long").alias("name_length"), F.concat("p_name", F.lit("/"), "p_brand").alias("joined"),
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("padded"), F.repeat(F.lit("*"), F.col("p_size") % 4).alias("stars"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"), F.substring_index("p_brand", "#", 1).alias("brand_word"))


@query("str_like_multi", views=("query_history",), sql="""
SELECT statement_id, CASE WHEN lower(error_message) LIKE '%insufficient%privilege%' OR lower(error_message) LIKE '%permission%denied%' THEN 'permission'
  WHEN lower(error_message) LIKE '%not found%' OR lower(error_message) LIKE '%does not exist%' THEN 'missing' ELSE 'other' END AS error_class
FROM query_history WHERE error_message IS NOT NULL""")
def str_like_multi(t):
    """Several LIKE patterns of one class become one alternation, so the text is read once per class."""
    text = F.lower("error_message")
    return t.query_history.where("error_message IS NOT NULL").select(
        "statement_id",
        F.when(text.rlike("insufficient.*privilege|permission.*denied"), "permission").when(
            text.rlike("not found|does not exist"), "missing").otherwise("other").alias("error_class"))


@query("str_fingerprint", views=("query_history",), sql="""
SELECT left(statement_text, 47) AS fingerprint, count(*) AS runs, count(DISTINCT executed_by) AS users FROM query_history GROUP BY 1""")
def str_fingerprint(t):
    return t.query_history.groupBy(F.left("statement_text", F.lit(47)).alias("fingerprint")).agg(
        F.count("*").alias("runs"), F.countDistinct("executed_by").alias("users"))


@query("str_mask", """
SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'U', 'g'), '[a-z]', 'l', 'g'), '[0-9]', 'n', 'g') AS masked FROM customer""")
def str_mask(t):
    masked = F.mask("c_name", upperChar=F.lit("U"), lowerChar=F.lit("l"), digitChar=F.lit("n"))
    return t.customer.select("c_custkey", masked.alias("masked"))


@query("str_mask_partial", views=("audit",), sql="""
SELECT event_id, '***-**-' || right(CAST(100000 + event_id AS VARCHAR), 4) AS masked_id,
       left(email, 3) || '***@' || split_part(email, '@', 2) AS masked_email FROM audit""")
def str_mask_partial(t):
    return t.audit.select(
        "event_id", mask_id((F.col("event_id") + 100000).cast("string")).alias("masked_id"), mask_email("email").alias("masked_email"))


@query("str_normalise_lookup", """
SELECT n_nationkey, CASE n_name WHEN 'UNITED STATES' THEN 'USA' WHEN 'UNITED KINGDOM' THEN 'UK' WHEN 'RUSSIA' THEN 'RUS' ELSE n_name END AS name
FROM nation""")
def str_normalise_lookup(t):
    names = {"UNITED STATES": "USA", "UNITED KINGDOM": "UK", "RUSSIA": "RUS"}
    return t.nation.select("n_nationkey", lookup("n_name", names).alias("name"))


@query("str_keyword_class", """
SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%' THEN 'fastener' WHEN lower(p_name) LIKE '%widget%' THEN 'widget' ELSE 'other' END AS class,
       CASE WHEN lower(p_name) LIKE '%red%' THEN 1.0::DOUBLE WHEN lower(p_name) LIKE '%blue%' THEN 0.7::DOUBLE ELSE 0.4::DOUBLE END AS weight FROM part""")
def str_keyword_class(t):
    return t.part.select(
        "p_partkey", keyword_class("p_name", [(("ring", "bolt"), "fastener"), (("widget",), "widget")], "other").alias("class"),
        keyword_class("p_name", [(("red",), 1.0), (("blue",), 0.7)], 0.4).alias("weight"))


@query("str_literal_join", "SELECT r_regionkey, 'one' || 'two' AS joined FROM region")
def str_literal_join(t):
    return t.spark.sql("SELECT r_regionkey, 'one' 'two' AS joined FROM {region}", region=t.region)


@query("date_extract", """
SELECT event_id, CAST(month(ts) AS INTEGER) AS month_no, CAST(year(ts) AS INTEGER) AS year_no, CAST(hour(ts) AS INTEGER) AS hour_no,
       CAST(quarter(ts) AS INTEGER) AS quarter_no, strftime(ts, '%Y-%m') AS year_month, CAST(ts AS DATE) AS day FROM events""")
def date_extract(t):
    return t.events.select(
        "event_id", F.month("ts").alias("month_no"), F.year("ts").alias("year_no"), F.hour("ts").alias("hour_no"),
        F.quarter("ts").alias("quarter_no"), F.date_format("ts", "yyyy-MM").alias("year_month"), F.to_date("ts").alias("day"))


@query("date_parse", """
SELECT event_id, date_trunc('second', ts) AS from_log, CAST(ts AS DATE) AS from_digits, date_trunc('second', ts) AS from_us,
       CAST(NULL AS TIMESTAMP) AS from_bad FROM events""")
def date_parse(t):
    text = t.events.select(
        "event_id", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss").alias("log"), F.date_format("ts", "yyyyMMdd").alias("digits"),
        F.date_format("ts", "MM-dd-yyyy HH:mm:ss").alias("us"))
    return text.select(
        "event_id", F.try_to_timestamp(F.concat("log", F.lit(" +0000")), F.lit("dd/MMM/yyyy:HH:mm:ss Z")).cast("timestamp_ntz").alias("from_log"),
        F.to_date("digits", "yyyyMMdd").alias("from_digits"),
        F.try_to_timestamp("us", F.lit("MM-dd-yyyy HH:mm:ss")).cast("timestamp_ntz").alias("from_us"),
        F.try_to_timestamp(F.concat(F.lit("x"), "us"), F.lit("MM-dd-yyyy HH:mm:ss")).cast("timestamp_ntz").alias("from_bad"))


@query("date_arith", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 10 AS plus_ten, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS plus_months,
       o_orderdate + INTERVAL 90 MINUTE AS plus_minutes, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS age_days FROM orders""")
def date_arith(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.date_add(day, 10).alias("plus_ten"), F.add_months(day, 2).alias("plus_months"),
        F.expr("timestampadd(MINUTE, 90, o_orderdate)").alias("plus_minutes"),
        F.datediff(F.lit("2001-08-01").cast("date"), day).cast("long").alias("age_days"))


@query("date_floor_5min", "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS floored FROM events")
def date_floor_5min(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", epoch_to_ntz(F.floor(seconds / 300) * 300).alias("floored"))


@query("date_duration", views=("run_timeline",), sql="""
SELECT job_id, CAST(sum(slice_sec) AS BIGINT) AS seconds FROM run_timeline GROUP BY 1""")
def date_duration(t):
    """Seconds between two instants, summed per job."""
    spans = t.run_timeline.select(
        "job_id", F.col("period_start_time").alias("a"),
        F.expr("period_start_time + make_dt_interval(0, 0, 0, slice_sec)").alias("b"))
    return spans.groupBy("job_id").agg(F.sum(F.expr("timestampdiff(SECOND, a, b)")).alias("seconds"))


@query("date_spine", """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS tick FROM b),
c AS (SELECT date_trunc('hour', ts) AS tick, count(*) AS n FROM events GROUP BY 1)
SELECT tick, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (tick)""")
def date_spine(t):
    """Every hour between the first and last event with its event count, quiet hours included."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    counts = t.events.groupBy(hour.alias("tick")).agg(F.count("*").alias("n"))
    spine = counts.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi")).select(
        F.explode(F.expr("sequence(lo, hi, INTERVAL 1 HOUR)")).alias("tick"))
    return spine.join(counts, "tick", "left").fillna(0, ["n"])


@query("math_ratio_pct", """
SELECT user_id, round(100.0 * count(*) FILTER (event_type = 'purchase') / CAST(nullif(count(*) FILTER (event_type = 'signup'), 0) AS DOUBLE), 2) AS pct FROM events GROUP BY 1""")
def math_ratio_pct(t):
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        rate_pct(F.count_if(kind == "purchase"), F.count_if(kind == "signup")).alias("pct"))


@query("math_units", views=("query_history",), sql="""
SELECT statement_id, total_duration_ms / 1000.0 AS sec, total_duration_ms / 60000.0 AS minutes, total_duration_ms / 3600000.0 AS hours,
       read_bytes / 1048576.0 AS mb, read_bytes / 1073741824.0 AS gb FROM query_history""")
def math_units(t):
    ms, size = F.col("total_duration_ms"), F.col("read_bytes")
    return t.query_history.select(
        "statement_id", (ms / 1000.0).alias("sec"), (ms / 60000.0).alias("minutes"), (ms / 3600000.0).alias("hours"),
        (size / 1048576.0).alias("mb"), (size / 1073741824.0).alias("gb"))


@query("math_misc", """
SELECT p_partkey, CAST(pow(p_size, 2) AS DOUBLE) AS squared, abs(p_size - 25) AS off, round(exp(-p_size / 10.0), 8) AS decay, round(p_retailprice, 0) AS rounded,
       CAST(floor(p_retailprice) AS BIGINT) AS whole, p_size % 7 AS remainder FROM part""")
def math_misc(t):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return t.part.select(
        "p_partkey", F.pow(size, F.lit(2)).alias("squared"), F.abs(size - 25).alias("off"), F.round(F.exp(-size / 10.0), 8).alias("decay"),
        F.round(price, 0).alias("rounded"), F.floor(price).alias("whole"), (size % 7).alias("remainder"))


@query("math_convert", "SELECT p_partkey, p_size * 2.54::DOUBLE AS size_cm FROM part")
def math_convert(t):
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION inch_to_cm(inches DOUBLE) RETURNS DOUBLE RETURN inches * 2.54D")
    return t.part.select("p_partkey", F.expr("inch_to_cm(p_size)").alias("size_cm"))


@query("arr_hof", """
SELECT p_partkey, [p_size * 1, p_size * 2, p_size * 3, 7] AS scaled, p_size * 6 + 7 AS total, p_size * 2 AS second, CAST(NULL AS INTEGER) AS tenth FROM part""")
def arr_hof(t):
    scaled = F.array_append(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda x: x * F.col("p_size")), F.lit(7))
    return t.part.select("p_partkey", scaled.alias("scaled")).select(
        "p_partkey", "scaled", F.aggregate("scaled", F.lit(0), lambda a, x: a + x).alias("total"), F.get("scaled", F.lit(1)).alias("second"),
        F.get("scaled", F.lit(9)).alias("tenth"))


@query("arr_contains", """
SELECT user_id, list_contains(list(DISTINCT event_type), 'error') AS had_error FROM events GROUP BY 1""")
def arr_contains(t):
    """Whether a group has a member, as a maximum: no set is collected for it."""
    return t.events.groupBy("user_id").agg(F.coalesce(F.max(F.col("event_type") == "error"), F.lit(False)).alias("had_error"))


@query("map_struct_access", """
SELECT c_custkey, c_mktsegment AS segment, c_nationkey AS nation_key, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS absent FROM customer""")
def map_struct_access(t):
    nested = t.customer.select(
        "c_custkey", F.create_map(F.lit("segment"), "c_mktsegment").alias("m"),
        F.named_struct(F.lit("geo"), F.named_struct(F.lit("nation"), "c_nationkey"), F.lit("balance"), "c_acctbal").alias("s"))
    return nested.select(
        "c_custkey", F.col("m")["segment"].alias("segment"), F.col("s.geo.nation").alias("nation_key"), F.col("s.balance").alias("balance"),
        F.col("m")["absent"].alias("absent"))


@query("map_size", views=("query_history",), sql="""
SELECT statement_id, CAST((tag_team IS NOT NULL)::INT + (tag_project IS NOT NULL)::INT AS INTEGER) AS tags FROM query_history
WHERE tag_team IS NOT NULL OR tag_project IS NOT NULL""")
def map_size(t):
    return t.query_history.select(
        "statement_id", F.size(tag_map(team="tag_team", project="tag_project")).alias("tags")).where("tags > 0")


@query("json_path", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, max(value) AS peak FROM events
WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 GROUP BY 1""")
def json_path(t):
    k = F.get_json_object("props", "$.k").try_cast("long").alias("k")
    return t.events.select(k, "value").where("k >= 50").groupBy("k").agg(F.count("*").alias("n"), F.max("value").alias("peak"))


@query("json_from_array", """
SELECT event_type AS dataset, 'small_k' AS rule, count(*) FILTER (k < 50) AS passed, count(*) FILTER (k >= 50) AS failed
FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""")
def json_from_array(t):
    """A JSON array of rule results per event, parsed to structs, exploded and summed."""
    k = F.get_json_object("props", "$.k").cast("long")
    as_text = F.to_json(F.array(F.struct(
        F.lit("small_k").alias("name"), F.col("event_type").alias("dataset"),
        F.when(k < 50, 1).otherwise(0).alias("passed_records"), F.when(k >= 50, 1).otherwise(0).alias("failed_records"))))
    kind = "array<struct<name:string,dataset:string,passed_records:int,failed_records:int>>"
    rules = t.events.select(F.explode(F.from_json(as_text, kind)).alias("r"))
    return rules.groupBy(F.col("r.dataset").alias("dataset"), F.col("r.name").alias("rule")).agg(
        F.sum("r.passed_records").alias("passed"), F.sum("r.failed_records").alias("failed"))


@query("json_to_text", """
SELECT r_regionkey, '{"key":' || r_regionkey || ',"name":"' || r_name || '"}' AS doc FROM region""")
def json_to_text(t):
    return t.region.select(
        "r_regionkey", F.to_json(F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))).alias("doc"))


@query("variant_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def variant_parse(t):
    parsed = t.events.select("event_id", F.try_parse_json("props").alias("v"))
    return parsed.select("event_id", F.variant_get("v", "$.k", "int").alias("k"))


@query("variant_path", """
SELECT event_id, user_id AS uid, value * 2 AS doubled, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS next_k FROM events""")
def variant_path(t):
    doc = t.events.select("event_id", F.to_variant_object(F.struct(
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"), "value",
        F.from_json("props", "k long").alias("props"))).alias("v"))
    return t.spark.sql("""
        SELECT event_id, v:user.id::bigint AS uid, v:value::double * 2 AS doubled, v:user.kind::string AS kind,
               v:props:k::bigint + 1 AS next_k FROM {doc}""".replace("v:props:k", "v:props.k"), doc=doc)


@query("variant_agg", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS bucket, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 20 GROUP BY 1""")
def variant_agg(t):
    typed = t.events.select(F.variant_get(F.parse_json("props"), "$.k", "long").alias("k"), "value").where("k > 20")
    return typed.groupBy((F.col("k") % 10).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("variant_shred", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""")
def variant_shred(t):
    parsed = t.events.select("event_id", F.parse_json("props").alias("v"))
    return shred(parsed, "v", {"k": ("$.k", "long"), "absent": ("$.a.b", "string")}).drop("v")


@query("variant_schema", "SELECT 'OBJECT<k: BIGINT>' AS found_schema, count(*) AS n FROM events")
def variant_schema(t):
    return t.events.select(F.parse_json("props").alias("v")).agg(
        F.schema_of_variant_agg("v").alias("found_schema"), F.count("*").alias("n"))
