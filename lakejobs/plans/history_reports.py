"""Reports over the query history view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators.ordered import discrete_percentiles
from lakejobs.operators.intervals import epoch_micros, epoch_to_ntz, peak_overlap
from lakejobs.operators.relational import count_where, rate_pct, since, sorted_set, tag_map
from lakejobs.registry import query
from lakejobs.tables import EVENTS_AS_OF

HISTORY = ("query_history",)
LAST = "start_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {} DAY"
MB = 1024.0 * 1024.0
GB = MB * 1024.0


def recent(t, days: int, condition: str | None = None):
    rows = t.query_history.where(since("start_time", EVENTS_AS_OF, days))
    return rows.where(condition) if condition else rows


def seconds(column: str, name: str):
    return (F.col(column) / 1000.0).alias(name)


def sum_seconds(column: str, name: str):
    return (F.sum(column) / 1000.0).alias(name)


def preview(size: int):
    return F.left("statement_text", F.lit(size)).alias("statement_preview")


def is_failed():
    return F.col("execution_status") == "FAILED"


def is_finished():
    return F.col("execution_status") == "FINISHED"


def report(key: str, sql: str):
    return query(key, sql=sql, views=HISTORY)


# --- row lists: newest or largest statements -------------------------------


@report("rep_failed_queries", f"""
SELECT statement_id, start_time, executed_by, execution_status, left(statement_text, 200) AS statement_preview,
       error_message, total_duration_ms, alert_id, dashboard_id, notebook_id, job_id
FROM query_history WHERE execution_status = 'FAILED' AND {LAST.format(7)}
ORDER BY start_time DESC, statement_id LIMIT 200""")
def rep_failed_queries(t):
    return recent(t, 7, "execution_status = 'FAILED'").select(
        "statement_id", "start_time", "executed_by", "execution_status", preview(200), "error_message",
        "total_duration_ms", "alert_id", "dashboard_id", "notebook_id", "job_id",
    ).orderBy(F.desc("start_time"), "statement_id").limit(200)


@report("rep_slow_canceled_queries", f"""
SELECT statement_id, start_time, executed_by, execution_status, total_duration_ms / 1000.0 AS duration_seconds,
       left(statement_text, 150) AS statement_preview, error_message
FROM query_history WHERE {LAST.format(7)} AND (execution_status = 'CANCELED' OR total_duration_ms > 300000)
ORDER BY total_duration_ms DESC, statement_id LIMIT 100""")
def rep_slow_canceled_queries(t):
    return recent(t, 7, "execution_status = 'CANCELED' OR total_duration_ms > 300000").orderBy(
        F.desc("total_duration_ms"), "statement_id").limit(100).select(
        "statement_id", "start_time", "executed_by", "execution_status",
        seconds("total_duration_ms", "duration_seconds"), preview(150), "error_message")


@report("rep_queries_high_io", f"""
SELECT statement_id, start_time, executed_by, total_duration_ms / 1000.0 AS duration_sec,
       read_bytes / {MB} AS read_mb, spilled_local_bytes / {MB} AS spill_mb, written_bytes / {MB} AS written_mb,
       read_rows, produced_rows, left(statement_text, 120) AS statement_preview
FROM query_history WHERE {LAST.format(7)} AND execution_status = 'FINISHED'
  AND (spilled_local_bytes > 0 OR read_bytes > 1000000000)
ORDER BY read_bytes DESC, statement_id LIMIT 50""")
def rep_queries_high_io(t):
    heavy = "execution_status = 'FINISHED' AND (spilled_local_bytes > 0 OR read_bytes > 1000000000)"
    return recent(t, 7, heavy).orderBy(F.desc("read_bytes"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("total_duration_ms", "duration_sec"),
        (F.col("read_bytes") / MB).alias("read_mb"), (F.col("spilled_local_bytes") / MB).alias("spill_mb"),
        (F.col("written_bytes") / MB).alias("written_mb"), "read_rows", "produced_rows", preview(120))


@report("rep_compilation_vs_execution_time", f"""
SELECT statement_id, start_time, executed_by, compilation_duration_ms / 1000.0 AS compile_sec,
       execution_duration_ms / 1000.0 AS execution_sec, total_duration_ms / 1000.0 AS total_sec,
       round(100.0 * compilation_duration_ms / CAST(total_duration_ms AS DOUBLE), 1) AS compile_pct,
       left(statement_text, 100) AS statement_preview
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND total_duration_ms > 0
ORDER BY compilation_duration_ms DESC, statement_id LIMIT 50""")
def rep_compilation_vs_execution_time(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND total_duration_ms > 0").orderBy(
        F.desc("compilation_duration_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("compilation_duration_ms", "compile_sec"),
        seconds("execution_duration_ms", "execution_sec"), seconds("total_duration_ms", "total_sec"),
        rate_pct(F.col("compilation_duration_ms"), F.col("total_duration_ms"), 1).alias("compile_pct"), preview(100))


@report("rep_most_data_scanned", f"""
SELECT statement_id, start_time, executed_by, read_bytes / {GB} AS read_gb, read_rows, read_files, pruned_files,
       total_duration_ms / 1000.0 AS duration_sec, left(statement_text, 120) AS statement_preview
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND read_bytes > 0
ORDER BY read_bytes DESC, statement_id LIMIT 50""")
def rep_most_data_scanned(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND read_bytes > 0").orderBy(
        F.desc("read_bytes"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", (F.col("read_bytes") / GB).alias("read_gb"), "read_rows",
        "read_files", "pruned_files", seconds("total_duration_ms", "duration_sec"), preview(120))


# The error text patterns of the two error reports.
PERMISSION_PATTERNS = ("%insufficient%privilege%", "%permission%denied%", "%access%denied%", "%cannot resolve%")
MISSING_PATTERNS = ("%table%not found%", "%cannot find%table%", "%schema%not found%", "%path does not exist%")


def like_any(column: str, patterns: tuple[str, ...]):
    """Case-insensitive test against several LIKE patterns."""
    lowered = F.lower(column)
    condition = lowered.like(patterns[0])
    for pattern in patterns[1:]:
        condition = condition | lowered.like(pattern)
    return condition


def like_any_sql(column: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"lower({column}) LIKE '{p}'" for p in patterns) + ")"


@report("rep_permission_errors", f"""
SELECT statement_id, start_time, executed_by, executed_as, left(error_message, 300) AS error_message,
       left(statement_text, 150) AS statement_preview
FROM query_history WHERE execution_status = 'FAILED' AND {LAST.format(14)}
  AND {like_any_sql('error_message', PERMISSION_PATTERNS)} ORDER BY start_time DESC, statement_id LIMIT 100""")
def rep_permission_errors(t):
    return recent(t, 14, "execution_status = 'FAILED'").where(like_any("error_message", PERMISSION_PATTERNS)).select(
        "statement_id", "start_time", "executed_by", "executed_as",
        F.left("error_message", F.lit(300)).alias("error_message"), preview(150),
    ).orderBy(F.desc("start_time"), "statement_id").limit(100)


@report("rep_table_not_found_errors", f"""
SELECT statement_id, start_time, executed_by, left(error_message, 400) AS error_message,
       left(statement_text, 200) AS statement_preview
FROM query_history WHERE execution_status = 'FAILED' AND {LAST.format(14)}
  AND {like_any_sql('error_message', MISSING_PATTERNS)} ORDER BY start_time DESC, statement_id LIMIT 50""")
def rep_table_not_found_errors(t):
    return recent(t, 14, "execution_status = 'FAILED'").where(like_any("error_message", MISSING_PATTERNS)).select(
        "statement_id", "start_time", "executed_by", F.left("error_message", F.lit(400)).alias("error_message"),
        preview(200),
    ).orderBy(F.desc("start_time"), "statement_id").limit(50)


@report("rep_queue_time", f"""
SELECT statement_id, start_time, executed_by, waiting_at_capacity_ms / 1000.0 AS queue_sec,
       waiting_for_compute_ms / 1000.0 AS provision_sec, total_duration_ms / 1000.0 AS total_sec, warehouse_id,
       left(statement_text, 100) AS statement_preview
FROM query_history WHERE {LAST.format(7)} AND waiting_at_capacity_ms > 0
ORDER BY waiting_at_capacity_ms DESC, statement_id LIMIT 100""")
def rep_queue_time(t):
    return recent(t, 7, "waiting_at_capacity_ms > 0").orderBy(
        F.desc("waiting_at_capacity_ms"), "statement_id").limit(100).select(
        "statement_id", "start_time", "executed_by", seconds("waiting_at_capacity_ms", "queue_sec"),
        seconds("waiting_for_compute_ms", "provision_sec"), seconds("total_duration_ms", "total_sec"),
        "warehouse_id", preview(100))


@report("rep_result_fetch_time", f"""
SELECT statement_id, start_time, executed_by, result_fetch_ms / 1000.0 AS result_fetch_sec,
       total_duration_ms / 1000.0 AS total_sec, produced_rows,
       round(100.0 * result_fetch_ms / CAST(total_duration_ms + result_fetch_ms AS DOUBLE), 1) AS fetch_pct
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND result_fetch_ms > 1000
ORDER BY result_fetch_ms DESC, statement_id LIMIT 50""")
def rep_result_fetch_time(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND result_fetch_ms > 1000").orderBy(
        F.desc("result_fetch_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("result_fetch_ms", "result_fetch_sec"),
        seconds("total_duration_ms", "total_sec"), "produced_rows",
        rate_pct(F.col("result_fetch_ms"), F.col("total_duration_ms") + F.col("result_fetch_ms"), 1).alias("fetch_pct"))


@report("rep_slowest_queries", f"""
SELECT statement_id, start_time, executed_by, total_duration_ms / 1000.0 AS duration_sec,
       execution_duration_ms / 1000.0 AS execution_sec, waiting_for_compute_ms / 1000.0 AS wait_compute_sec,
       waiting_at_capacity_ms / 1000.0 AS wait_capacity_sec, read_bytes / {GB} AS read_gb, produced_rows,
       left(statement_text, 150) AS statement_preview
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)}
ORDER BY total_duration_ms DESC, statement_id LIMIT 50""")
def rep_slowest_queries(t):
    return recent(t, 7, "execution_status = 'FINISHED'").orderBy(
        F.desc("total_duration_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("total_duration_ms", "duration_sec"),
        seconds("execution_duration_ms", "execution_sec"), seconds("waiting_for_compute_ms", "wait_compute_sec"),
        seconds("waiting_at_capacity_ms", "wait_capacity_sec"), (F.col("read_bytes") / GB).alias("read_gb"),
        "produced_rows", preview(150))


@report("rep_zero_row_queries", f"""
SELECT statement_id, start_time, executed_by, total_duration_ms / 1000.0 AS duration_sec,
       read_bytes / {MB} AS read_mb, left(statement_text, 150) AS statement_preview
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND produced_rows = 0 AND read_bytes > 0
ORDER BY read_bytes DESC, statement_id LIMIT 100""")
def rep_zero_row_queries(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND produced_rows = 0 AND read_bytes > 0").orderBy(
        F.desc("read_bytes"), "statement_id").limit(100).select(
        "statement_id", "start_time", "executed_by", seconds("total_duration_ms", "duration_sec"),
        (F.col("read_bytes") / MB).alias("read_mb"), preview(150))


@report("rep_longest_wait", f"""
SELECT statement_id, start_time, executed_by, waiting_for_compute_ms / 1000.0 AS wait_provision_sec,
       waiting_at_capacity_ms / 1000.0 AS wait_capacity_sec, total_duration_ms / 1000.0 AS total_sec, warehouse_id
FROM query_history WHERE {LAST.format(7)} AND waiting_for_compute_ms > 0
ORDER BY waiting_for_compute_ms DESC, statement_id LIMIT 50""")
def rep_longest_wait(t):
    return recent(t, 7, "waiting_for_compute_ms > 0").orderBy(
        F.desc("waiting_for_compute_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("waiting_for_compute_ms", "wait_provision_sec"),
        seconds("waiting_at_capacity_ms", "wait_capacity_sec"), seconds("total_duration_ms", "total_sec"),
        "warehouse_id")


@report("rep_canceled_queries", f"""
SELECT statement_id, start_time, executed_by, total_duration_ms / 1000.0 AS duration_before_cancel_sec,
       left(statement_text, 120) AS statement_preview
FROM query_history WHERE execution_status = 'CANCELED' AND {LAST.format(7)}
ORDER BY start_time DESC, statement_id LIMIT 100""")
def rep_canceled_queries(t):
    return recent(t, 7, "execution_status = 'CANCELED'").orderBy(
        F.desc("start_time"), "statement_id").limit(100).select(
        "statement_id", "start_time", "executed_by", seconds("total_duration_ms", "duration_before_cancel_sec"),
        preview(120))


@report("rep_slow_compile", f"""
SELECT statement_id, start_time, executed_by, compilation_duration_ms / 1000.0 AS compile_sec,
       execution_duration_ms / 1000.0 AS execution_sec,
       round(100.0 * compilation_duration_ms / CAST(nullif(total_duration_ms, 0) AS DOUBLE), 1) AS compile_pct,
       left(statement_text, 100) AS statement_preview
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND compilation_duration_ms > 5000
ORDER BY compilation_duration_ms DESC, statement_id LIMIT 50""")
def rep_slow_compile(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND compilation_duration_ms > 5000").orderBy(
        F.desc("compilation_duration_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", seconds("compilation_duration_ms", "compile_sec"),
        seconds("execution_duration_ms", "execution_sec"),
        rate_pct(F.col("compilation_duration_ms"), F.col("total_duration_ms"), 1).alias("compile_pct"), preview(100))


@report("rep_long_running", f"""
SELECT statement_id, start_time, executed_by, total_duration_ms / 60000.0 AS duration_min,
       read_bytes / {GB} AS read_gb, left(statement_text, 120) AS statement_preview
FROM query_history WHERE execution_status IN ('FINISHED', 'CANCELED', 'FAILED') AND {LAST.format(7)}
  AND total_duration_ms > 1800000 ORDER BY total_duration_ms DESC, statement_id LIMIT 50""")
def rep_long_running(t):
    ended = "execution_status IN ('FINISHED', 'CANCELED', 'FAILED') AND total_duration_ms > 1800000"
    return recent(t, 7, ended).orderBy(F.desc("total_duration_ms"), "statement_id").limit(50).select(
        "statement_id", "start_time", "executed_by", (F.col("total_duration_ms") / 60000.0).alias("duration_min"),
        (F.col("read_bytes") / GB).alias("read_gb"), preview(120))


@report("rep_history_preview", f"""
SELECT least(5, count(*)) AS previewed, least(5, count(*)) AS in_window FROM query_history WHERE {LAST.format(30)}""")
def rep_history_preview(t):
    """Any five recent statements, given as their number and how many fall into the window."""
    preview = recent(t, 30).select("account_id", "workspace_id", "executed_by", "start_time", "execution_status").limit(5)
    return preview.agg(F.count("*").alias("previewed"), F.count_if(F.col("start_time").isNotNull()).alias("in_window"))


# --- grouped reports --------------------------------------------------------


@report("rep_failures_user", f"""
SELECT executed_by, count(*) AS failure_count,
       coalesce(list_sort(list(DISTINCT left(error_message, 80)) FILTER (error_message IS NOT NULL)), []) AS sample_errors
FROM query_history WHERE execution_status = 'FAILED' AND {LAST.format(14)} GROUP BY executed_by""")
def rep_failures_user(t):
    failed = recent(t, 14, "execution_status = 'FAILED'").withColumn("brief", F.left("error_message", F.lit(80)))
    return failed.groupBy("executed_by").agg(
        F.count("*").alias("failure_count"), sorted_set("brief").alias("sample_errors")).orderBy(F.desc("failure_count"))


@report("rep_common_error_messages", f"""
SELECT left(error_message, 120) AS error_preview, count(*) AS occurrence_count,
       count(DISTINCT executed_by) AS distinct_users
FROM query_history WHERE execution_status = 'FAILED' AND error_message IS NOT NULL AND {LAST.format(14)}
GROUP BY 1 ORDER BY occurrence_count DESC, error_preview LIMIT 50""")
def rep_common_error_messages(t):
    return recent(t, 14, "execution_status = 'FAILED' AND error_message IS NOT NULL").groupBy(
        F.left("error_message", F.lit(120)).alias("error_preview")
    ).agg(F.count("*").alias("occurrence_count"), F.countDistinct("executed_by").alias("distinct_users")).orderBy(
        F.desc("occurrence_count"), "error_preview").limit(50)


def _cache_hits(t, total: str, rate: str):
    hits = count_where(F.col("from_result_cache"))
    return recent(t, 7, "execution_status = 'FINISHED'").groupBy(F.to_date("start_time").alias("query_date")).agg(
        F.count("*").alias(total), hits.alias("cache_hits"), rate_pct(hits, F.count("*")).alias(rate)).orderBy(F.desc("query_date"))


def _cache_hits_sql(total: str, rate: str) -> str:
    return f"""
SELECT CAST(start_time AS DATE) AS query_date, count(*) AS {total},
       count(*) FILTER (from_result_cache) AS cache_hits,
       round(100.0 * count(*) FILTER (from_result_cache) / CAST(count(*) AS DOUBLE), 2) AS {rate}
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} GROUP BY 1"""


@report("rep_query_result_cache_hit_rate", _cache_hits_sql("total_queries", "cache_hit_rate_pct"))
def rep_query_result_cache_hit_rate(t):
    return _cache_hits(t, "total_queries", "cache_hit_rate_pct")


@report("rep_cache_savings", _cache_hits_sql("total_finished", "cache_hit_pct"))
def rep_cache_savings(t):
    return _cache_hits(t, "total_finished", "cache_hit_pct")


@report("rep_alert_triggered_queries", f"""
SELECT alert_id, count(*) AS runs, count(*) FILTER (execution_status = 'FAILED') AS failures,
       min(start_time) AS first_run, max(start_time) AS last_run
FROM query_history WHERE {LAST.format(7)} AND alert_id IS NOT NULL GROUP BY alert_id""")
def rep_alert_triggered_queries(t):
    return recent(t, 7, "alert_id IS NOT NULL").groupBy("alert_id").agg(
        F.count("*").alias("runs"), count_where(is_failed()).alias("failures"), F.min("start_time").alias("first_run"),
        F.max("start_time").alias("last_run")).orderBy(F.desc("runs"))


def _count_and_time(t, key: str):
    return recent(t, 7, f"{key} IS NOT NULL").groupBy(key).agg(
        F.count("*").alias("query_count"), sum_seconds("total_duration_ms", "total_duration_sec")
    ).orderBy(F.desc("query_count"), key).limit(50)


def _count_and_time_sql(key: str) -> str:
    return f"""
SELECT {key}, count(*) AS query_count, CAST(sum(total_duration_ms) AS BIGINT) / 1000.0 AS total_duration_sec
FROM query_history WHERE {LAST.format(7)} AND {key} IS NOT NULL GROUP BY {key}
ORDER BY query_count DESC, {key} LIMIT 50"""


@report("rep_dashboard_triggered_queries", _count_and_time_sql("dashboard_id"))
def rep_dashboard_triggered_queries(t):
    return _count_and_time(t, "dashboard_id")


@report("rep_queries_jobs", _count_and_time_sql("job_id"))
def rep_queries_jobs(t):
    return _count_and_time(t, "job_id")


FAILURE_COLUMNS_SQL = """count(*) FILTER (execution_status = 'FAILED') AS failures,
       round(100.0 * count(*) FILTER (execution_status = 'FAILED') / CAST(count(*) AS DOUBLE), 2) AS failure_rate_pct"""


def failures_by(rows, key, total: str = "total_queries", at_least: int = 0):
    """Statements, failures and failure rate per key, for keys with enough statements."""
    failures = count_where(is_failed())
    return rows.groupBy(key).agg(
        F.count("*").alias(total), failures.alias("failures"), rate_pct(failures, F.count("*")).alias("failure_rate_pct")
    ).where(F.col(total) >= at_least)


@report("rep_failure_rate_client", f"""
SELECT coalesce(client_application, 'unknown') AS client_application, count(*) AS total_queries, {FAILURE_COLUMNS_SQL}
FROM query_history WHERE {LAST.format(14)} GROUP BY 1 HAVING count(*) >= 5""")
def rep_failure_rate_client(t):
    client = F.coalesce("client_application", F.lit("unknown")).alias("client_application")
    return failures_by(recent(t, 14), client, at_least=5).orderBy(F.desc("failure_rate_pct"), F.desc("failures"))


@report("rep_failure_rate_warehouse", f"""
SELECT warehouse_id, count(*) AS total_queries, {FAILURE_COLUMNS_SQL}
FROM query_history WHERE {LAST.format(14)} AND warehouse_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 10""")
def rep_failure_rate_warehouse(t):
    return failures_by(recent(t, 14, "warehouse_id IS NOT NULL"), F.col("warehouse_id"), at_least=10).orderBy(
        F.desc("failure_rate_pct"), F.desc("failures"))


@report("rep_daily_failure_rate", f"""
SELECT CAST(start_time AS DATE) AS query_date, count(*) AS total_queries, {FAILURE_COLUMNS_SQL}
FROM query_history WHERE {LAST.format(14)} GROUP BY 1""")
def rep_daily_failure_rate(t):
    return failures_by(recent(t, 14), F.to_date("start_time").alias("query_date")).orderBy(F.desc("query_date"))


@report("rep_alert_failure_rate", f"""
SELECT alert_id, count(*) AS total_runs, {FAILURE_COLUMNS_SQL}
FROM query_history WHERE {LAST.format(14)} AND alert_id IS NOT NULL GROUP BY 1""")
def rep_alert_failure_rate(t):
    return failures_by(recent(t, 14, "alert_id IS NOT NULL"), F.col("alert_id"), "total_runs").orderBy(
        F.desc("failure_rate_pct"), F.desc("failures"))


@report("rep_io_cache_effect", f"""
SELECT CAST(start_time AS DATE) AS query_date, count(*) AS queries_with_reads,
       CAST(sum(read_io_cache_percent) AS BIGINT) / CAST(count(*) AS DOUBLE) AS avg_cache_pct,
       CAST(sum(read_bytes) AS BIGINT) / {GB} AS total_read_gb
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND read_bytes > 0 GROUP BY 1""")
def rep_io_cache_effect(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND read_bytes > 0").groupBy(
        F.to_date("start_time").alias("query_date")
    ).agg(F.count("*").alias("queries_with_reads"), F.avg("read_io_cache_percent").alias("avg_cache_pct"),
          (F.sum("read_bytes") / GB).alias("total_read_gb")).orderBy(F.desc("query_date"))


@report("rep_peak_concurrency", f"""
SELECT date_trunc('hour', start_time) AS hour_utc, count(*) AS queries_started_in_hour
FROM query_history WHERE {LAST.format(7)} AND end_time IS NOT NULL GROUP BY 1
ORDER BY queries_started_in_hour DESC, hour_utc LIMIT 50""")
def rep_peak_concurrency(t):
    return recent(t, 7, "end_time IS NOT NULL").groupBy(hour_utc()).agg(
        F.count("*").alias("queries_started_in_hour")).orderBy(F.desc("queries_started_in_hour"), "hour_utc").limit(50)


def hour_utc():
    return F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour_utc")


@report("rep_warehouse_utilization", f"""
SELECT warehouse_id, date_trunc('hour', start_time) AS hour_utc, count(*) AS query_count,
       CAST(sum(total_duration_ms) AS BIGINT) / 1000.0 AS total_duration_sec
FROM query_history WHERE {LAST.format(7)} AND warehouse_id IS NOT NULL GROUP BY ALL""")
def rep_warehouse_utilization(t):
    return recent(t, 7, "warehouse_id IS NOT NULL").groupBy("warehouse_id", hour_utc()).agg(
        F.count("*").alias("query_count"), sum_seconds("total_duration_ms", "total_duration_sec")
    ).orderBy(F.desc("hour_utc"), F.desc("query_count"))


@report("rep_concurrency_by_warehouse", f"""
SELECT warehouse_id, date_trunc('hour', start_time) AS hour_utc, count(*) AS queries_in_hour
FROM query_history WHERE {LAST.format(7)} AND warehouse_id IS NOT NULL GROUP BY ALL
ORDER BY queries_in_hour DESC, warehouse_id, hour_utc LIMIT 100""")
def rep_concurrency_by_warehouse(t):
    return recent(t, 7, "warehouse_id IS NOT NULL").groupBy("warehouse_id", hour_utc()).agg(
        F.count("*").alias("queries_in_hour")).orderBy(F.desc("queries_in_hour"), "warehouse_id", "hour_utc").limit(100)


@report("rep_queries_hour", f"""
SELECT CAST(hour(start_time) AS INTEGER) AS hour_utc, count(*) AS query_count,
       count(*) FILTER (execution_status = 'FINISHED') AS finished
FROM query_history WHERE {LAST.format(14)} GROUP BY 1""")
def rep_queries_hour(t):
    return recent(t, 14).groupBy(F.hour("start_time").alias("hour_utc")).agg(
        F.count("*").alias("query_count"), count_where(is_finished()).alias("finished")).orderBy("hour_utc")


@report("rep_dashboard_load_by_hour", f"""
SELECT CAST(hour(start_time) AS INTEGER) AS hour_utc, count(*) AS dashboard_query_count
FROM query_history WHERE {LAST.format(7)} AND dashboard_id IS NOT NULL GROUP BY 1""")
def rep_dashboard_load_by_hour(t):
    return recent(t, 7, "dashboard_id IS NOT NULL").groupBy(F.hour("start_time").alias("hour_utc")).agg(
        F.count("*").alias("dashboard_query_count")).orderBy("hour_utc")


@report("rep_queries_per_user", f"""
SELECT executed_by, count(*) AS query_count, count(DISTINCT CAST(start_time AS DATE)) AS active_days,
       count(*) FILTER (execution_status = 'FINISHED') AS finished, count(*) FILTER (execution_status = 'FAILED') AS failed
FROM query_history WHERE {LAST.format(7)} GROUP BY executed_by ORDER BY query_count DESC, executed_by LIMIT 50""")
def rep_queries_per_user(t):
    return recent(t, 7).groupBy("executed_by").agg(
        F.count("*").alias("query_count"), F.countDistinct(F.to_date("start_time")).alias("active_days"),
        count_where(is_finished()).alias("finished"), count_where(is_failed()).alias("failed"),
    ).orderBy(F.desc("query_count"), "executed_by").limit(50)


@report("rep_run_as_vs_executed", f"""
SELECT executed_by AS user_who_triggered, executed_as AS identity_used_for_privileges, count(*) AS query_count
FROM query_history WHERE {LAST.format(14)} AND executed_by <> executed_as GROUP BY ALL""")
def rep_run_as_vs_executed(t):
    return recent(t, 14, "executed_by <> executed_as").groupBy(
        F.col("executed_by").alias("user_who_triggered"), F.col("executed_as").alias("identity_used_for_privileges")
    ).agg(F.count("*").alias("query_count")).orderBy(F.desc("query_count"))


@report("rep_idle_warehouses", f"""
SELECT warehouse_id, count(*) AS query_count_7d, CAST(sum(total_duration_ms) AS BIGINT) / 1000.0 AS total_duration_sec
FROM query_history WHERE {LAST.format(7)} AND warehouse_id IS NOT NULL GROUP BY 1 HAVING count(*) < 10""")
def rep_idle_warehouses(t):
    return idle_warehouses(t)


def idle_warehouses(t, fewer_than: int = 10):
    """Warehouses with few statements in a week."""
    return recent(t, 7, "warehouse_id IS NOT NULL").groupBy("warehouse_id").agg(
        F.count("*").alias("query_count_7d"), sum_seconds("total_duration_ms", "total_duration_sec")
    ).where(F.col("query_count_7d") < fewer_than).orderBy("query_count_7d")


@report("rep_top_users_compute", f"""
SELECT executed_by, count(*) AS query_count, CAST(sum(total_duration_ms) AS BIGINT) / 3600000.0 AS total_hours,
       CAST(sum(execution_duration_ms) AS BIGINT) / 3600000.0 AS execution_hours
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} GROUP BY executed_by
ORDER BY total_hours DESC, executed_by LIMIT 50""")
def rep_top_users_compute(t):
    return recent(t, 7, "execution_status = 'FINISHED'").groupBy("executed_by").agg(
        F.count("*").alias("query_count"), (F.sum("total_duration_ms") / 3600000.0).alias("total_hours"),
        (F.sum("execution_duration_ms") / 3600000.0).alias("execution_hours"),
    ).orderBy(F.desc("total_hours"), "executed_by").limit(50)


@report("rep_duration_percentiles", f"""
SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY total_duration_ms) / 1000.0 AS p50_duration_sec,
       percentile_disc(0.9) WITHIN GROUP (ORDER BY total_duration_ms) / 1000.0 AS p90_duration_sec,
       percentile_disc(0.99) WITHIN GROUP (ORDER BY total_duration_ms) / 1000.0 AS p99_duration_sec,
       CAST(sum(total_duration_ms) AS BIGINT) / CAST(count(*) AS DOUBLE) / 1000.0 AS avg_duration_sec,
       count(*) AS query_count
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)}""")
def rep_duration_percentiles(t):
    finished = recent(t, 7, "execution_status = 'FINISHED'")
    found = discrete_percentiles(finished, [], "total_duration_ms", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    whole = finished.agg(F.avg("total_duration_ms").alias("mean"), F.count("*").alias("query_count"))
    return whole.select(F.struct("mean", "query_count").alias("w"), F.lit(1).alias("one")).join(
        found.withColumn("one", F.lit(1)), "one", "left").select(
        *[(F.col(p) / 1000.0).alias(f"{p}_duration_sec") for p in ("p50", "p90", "p99")],
        (F.col("w.mean") / 1000.0).alias("avg_duration_sec"), F.col("w.query_count").alias("query_count"))


@report("rep_repeated_queries", f"""
SELECT left(statement_text, 80) AS query_fingerprint, count(*) AS run_count, count(DISTINCT executed_by) AS distinct_users
FROM query_history WHERE execution_status = 'FINISHED' AND {LAST.format(7)} AND length(statement_text) > 10
GROUP BY 1 HAVING count(*) >= 5 ORDER BY run_count DESC, query_fingerprint LIMIT 50""")
def rep_repeated_queries(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND length(statement_text) > 10").groupBy(
        F.left("statement_text", F.lit(80)).alias("query_fingerprint")
    ).agg(F.count("*").alias("run_count"), F.countDistinct("executed_by").alias("distinct_users")).where(
        "run_count >= 5").orderBy(F.desc("run_count"), "query_fingerprint").limit(50)


@report("rep_tagged_queries_by_user", f"""
SELECT executed_by, count(*) AS tagged_query_count
FROM query_history WHERE {LAST.format(7)} AND (tag_team IS NOT NULL OR tag_project IS NOT NULL)
GROUP BY 1 ORDER BY tagged_query_count DESC, executed_by LIMIT 30""")
def rep_tagged_queries_by_user(t):
    tags = tag_map(team="tag_team", project="tag_project")
    return recent(t, 7).where(F.size(tags) > 0).groupBy("executed_by").agg(
        F.count("*").alias("tagged_query_count")).orderBy(F.desc("tagged_query_count"), "executed_by").limit(30)


@report("rep_client_apps", f"""
SELECT coalesce(client_application, 'unknown') AS client_application, count(*) AS query_count
FROM query_history WHERE {LAST.format(7)} GROUP BY 1 ORDER BY query_count DESC, 1 LIMIT 30""")
def rep_client_apps(t):
    return recent(t, 7).groupBy(
        F.coalesce("client_application", F.lit("unknown")).alias("client_application")
    ).agg(F.count("*").alias("query_count")).orderBy(F.desc("query_count"), "client_application").limit(30)


@report("rep_notebook_share", f"""
SELECT CASE WHEN notebook_id IS NULL THEN 'other' ELSE 'notebook' END AS source_type, count(*) AS query_count
FROM query_history WHERE {LAST.format(7)} GROUP BY 1""")
def rep_notebook_share(t):
    source = F.when(F.col("notebook_id").isNotNull(), "notebook").otherwise("other").alias("source_type")
    return recent(t, 7).groupBy(source).agg(F.count("*").alias("query_count"))


@report("rep_rows_read_written", f"""
SELECT CAST(start_time AS DATE) AS query_date, CAST(sum(read_rows) AS BIGINT) AS total_read_rows,
       CAST(sum(written_rows) AS BIGINT) AS total_written_rows, CAST(sum(produced_rows) AS BIGINT) AS total_produced_rows
FROM query_history WHERE {LAST.format(7)} AND execution_status = 'FINISHED' GROUP BY 1""")
def rep_rows_read_written(t):
    return recent(t, 7, "execution_status = 'FINISHED'").groupBy(F.to_date("start_time").alias("query_date")).agg(
        F.sum("read_rows").alias("total_read_rows"), F.sum("written_rows").alias("total_written_rows"),
        F.sum("produced_rows").alias("total_produced_rows")).orderBy(F.desc("query_date"))


@report("rep_spill_by_user", f"""
SELECT executed_by, count(*) AS queries_with_spill, CAST(sum(spilled_local_bytes) AS BIGINT) / {GB} AS total_spill_gb
FROM query_history WHERE {LAST.format(7)} AND execution_status = 'FINISHED' AND spilled_local_bytes > 0
GROUP BY 1 ORDER BY total_spill_gb DESC, executed_by LIMIT 30""")
def rep_spill_by_user(t):
    return recent(t, 7, "execution_status = 'FINISHED' AND spilled_local_bytes > 0").groupBy("executed_by").agg(
        F.count("*").alias("queries_with_spill"), (F.sum("spilled_local_bytes") / GB).alias("total_spill_gb")
    ).orderBy(F.desc("total_spill_gb"), "executed_by").limit(30)


@report("rep_queue_underprovisioned", f"""
SELECT warehouse_id, count(*) AS queries_with_queue,
       round(CAST(sum(waiting_at_capacity_ms) AS BIGINT) / CAST(count(*) AS DOUBLE) / 1000.0, 1) AS avg_queue_sec,
       round(max(waiting_at_capacity_ms) / 1000.0, 1) AS max_queue_sec
FROM query_history WHERE {LAST.format(7)} AND warehouse_id IS NOT NULL AND waiting_at_capacity_ms > 0
GROUP BY 1 HAVING count(*) >= 5 ORDER BY avg_queue_sec DESC, warehouse_id LIMIT 20""")
def rep_queue_underprovisioned(t):
    return recent(t, 7, "warehouse_id IS NOT NULL AND waiting_at_capacity_ms > 0").groupBy("warehouse_id").agg(
        F.count("*").alias("queries_with_queue"),
        F.round(F.avg("waiting_at_capacity_ms") / 1000.0, 1).alias("avg_queue_sec"),
        F.round(F.max("waiting_at_capacity_ms") / 1000.0, 1).alias("max_queue_sec"),
    ).where("queries_with_queue >= 5").orderBy(F.desc("avg_queue_sec"), "warehouse_id").limit(20)


@report("rep_peak_running_queued", """
WITH q AS (SELECT warehouse_id, waiting_at_capacity_ms + waiting_for_compute_ms AS queued_ms,
                  epoch_us(start_time) AS s, epoch_us(start_time) + 1000 * total_duration_ms AS e
           FROM query_history WHERE warehouse_id IS NOT NULL),
span AS (SELECT warehouse_id, queued_ms, s // 1000000 AS s, least(s + 1000 * queued_ms, e) // 1000000 AS m, e // 1000000 AS e FROM q),
tick AS (SELECT warehouse_id, queued_ms, s, m, e, unnest(generate_series(s, e)) AS sec FROM span),
per_second AS (SELECT warehouse_id, sec, count(*) FILTER (sec >= m) AS running,
                      count(*) FILTER (sec <= m AND queued_ms > 0) AS queued FROM tick GROUP BY ALL)
SELECT warehouse_id, make_timestamp(sec // 300 * 300000000) AS five_min_interval,
       max(running) AS peak_running, max(queued) AS peak_queued
FROM per_second GROUP BY ALL""")
def rep_peak_running_queued(t):
    """Peak running and queued statements per warehouse and 5 minutes, counted by second."""
    start = epoch_micros("start_time")
    end = start + F.col("total_duration_ms") * 1000
    queued_ms = F.col("waiting_at_capacity_ms") + F.col("waiting_for_compute_ms")
    spans = t.query_history.where("warehouse_id IS NOT NULL").select(
        "warehouse_id", queued_ms.alias("queued_ms"),
        start.alias("s"), F.least(start + queued_ms * 1000, end).alias("m"), end.alias("e"),
    ).select(
        "warehouse_id", "queued_ms",
        *[F.floor(F.col(c) / 1_000_000).cast("long").alias(c) for c in ("s", "m", "e")],
    )
    run = F.struct(F.col("m").alias("lo"), F.col("e").alias("hi"), F.lit(1).alias("running"), F.lit(0).alias("queued"))
    wait = F.struct(F.col("s").alias("lo"), F.col("m").alias("hi"), F.lit(0).alias("running"), F.lit(1).alias("queued"))
    parts = F.explode(F.when(F.col("queued_ms") > 0, F.array(run, wait)).otherwise(F.array(run))).alias("part")
    peaks = peak_overlap(
        spans.select("warehouse_id", parts).select("warehouse_id", "part.*"), ["warehouse_id"], "lo", "hi",
        {"peak_running": "running", "peak_queued": "queued"},
    )
    return peaks.select(
        "warehouse_id", epoch_to_ntz(F.col("bucket") * 300).alias("five_min_interval"), "peak_running", "peak_queued"
    ).orderBy("warehouse_id", "five_min_interval")
