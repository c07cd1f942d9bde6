"""Reports over job runs: a run is the roll-up of its timeline slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.ordered import discrete_percentiles
from lakejobs.operators.relational import count_where, rate_pct, since
from lakejobs.registry import query
from lakejobs.tables import EVENTS_AS_OF

TIMELINE = ("run_timeline",)
LAST = "period_start_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {} DAY"

RUNS_SQL = """runs AS (
  SELECT job_id, run_id, min(period_start_time) AS run_start,
         max(epoch_us(period_start_time) // 1000000 + slice_sec) AS run_end_sec,
         CAST(sum(slice_sec) AS BIGINT) AS duration_sec,
         arg_max(result_state, (period_start_time, slice_id)) FILTER (result_state IS NOT NULL) AS result_state
  FROM run_timeline WHERE {last} GROUP BY job_id, run_id)"""


def recent(t, days: int) -> DataFrame:
    return t.run_timeline.where(since("period_start_time", EVENTS_AS_OF, days))


def runs(slices: DataFrame, state: str = "last") -> DataFrame:
    """One row per (job, run): start, end, seconds and outcome.

    ``state="last"`` takes the newest reported state; ``"alphabetical"`` keeps the
    greatest state text, under which a success hides an earlier failure.
    """
    outcome = (
        F.max_by("result_state", F.when(F.col("result_state").isNotNull(), F.struct("period_start_time", "slice_id")))
        if state == "last"
        else F.max("result_state")
    )
    end = F.unix_timestamp(F.col("period_start_time").cast("timestamp")) + F.col("slice_sec")
    return slices.groupBy("job_id", "run_id").agg(
        F.min("period_start_time").alias("run_start"), F.max(end).alias("run_end_sec"),
        F.sum("slice_sec").alias("duration_sec"), outcome.alias("result_state"),
    )


def is_failed():
    return F.col("result_state") == "FAILED"


def is_success():
    return F.col("result_state") == "SUCCESS"


@query("rep_job_run_failures", views=TIMELINE, sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(14))}
SELECT job_id, run_id AS job_run_id, run_start AS start_time, make_timestamp(run_end_sec * 1000000) AS end_time,
       duration_sec, result_state
FROM runs WHERE result_state = 'FAILED' ORDER BY start_time DESC, job_id, job_run_id LIMIT 100""")
def rep_job_run_failures(t):
    return runs(recent(t, 14)).where(is_failed()).select(
        "job_id", F.col("run_id").alias("job_run_id"), F.col("run_start").alias("start_time"),
        F.timestamp_seconds("run_end_sec").cast("timestamp_ntz").alias("end_time"), "duration_sec", "result_state",
    ).orderBy(F.desc("start_time"), "job_id", "job_run_id").limit(100)


@query("rep_job_frequency", views=TIMELINE, sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(14))}
SELECT job_id, count(*) AS run_count, count(*) / 14.0 AS runs_per_day,
       min(run_start) AS first_run, max(run_start) AS last_run,
       count(*) FILTER (result_state = 'SUCCESS') AS success_count,
       count(*) FILTER (result_state = 'FAILED') AS fail_count
FROM runs GROUP BY job_id ORDER BY run_count DESC, job_id LIMIT 50""")
def rep_job_frequency(t):
    """``runs`` is already one row per run, so a plain count replaces the distinct count."""
    return runs(recent(t, 14)).groupBy("job_id").agg(
        F.count("*").alias("run_count"), (F.count("*") / 14.0).alias("runs_per_day"), F.min("run_start").alias("first_run"),
        F.max("run_start").alias("last_run"), count_where(is_success()).alias("success_count"),
        count_where(is_failed()).alias("fail_count"),
    ).orderBy(F.desc("run_count"), "job_id").limit(50)


@query("rep_job_run_duration_trend", views=TIMELINE, sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(30))}
SELECT job_id, CAST(run_start AS DATE) AS run_date, count(*) AS run_count,
       CAST(sum(duration_sec) AS BIGINT) / CAST(count(*) AS DOUBLE) AS avg_duration_sec,
       max(duration_sec) AS max_duration_sec
FROM runs WHERE result_state = 'SUCCESS' GROUP BY ALL""")
def rep_job_run_duration_trend(t):
    return runs(recent(t, 30)).where(is_success()).groupBy("job_id", F.to_date("run_start").alias("run_date")).agg(
        F.count("*").alias("run_count"), F.avg("duration_sec").alias("avg_duration_sec"),
        F.max("duration_sec").alias("max_duration_sec"),
    ).orderBy(F.desc("run_date"), F.desc("avg_duration_sec"))


@query("rep_jobs_always_fail", views=TIMELINE, sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(14))}
SELECT job_id, count(*) AS total_runs, count(*) FILTER (result_state = 'FAILED') AS failed_runs,
       min(run_start) AS first_failure, max(run_start) AS last_failure
FROM runs GROUP BY job_id HAVING count(*) FILTER (result_state = 'SUCCESS') = 0""")
def rep_jobs_always_fail(t):
    return jobs_always_fail(t)


def jobs_always_fail(t, days: int = 14):
    """Jobs without a successful run."""
    return runs(recent(t, days)).groupBy("job_id").agg(
        F.count("*").alias("total_runs"), count_where(is_failed()).alias("failed_runs"), F.min("run_start").alias("first_failure"),
        F.max("run_start").alias("last_failure"), count_where(is_success()).alias("_ok"),
    ).where("_ok = 0").drop("_ok").orderBy(F.desc("total_runs"))


@query("rep_jobs_not_run_30d", views=TIMELINE, sql="""
WITH newest AS (SELECT job_id, max(period_start_time) AS last_run_time FROM run_timeline
                WHERE period_start_time >= TIMESTAMP '2024-03-01' - INTERVAL 365 DAY GROUP BY 1)
SELECT job_id, last_run_time, date_diff('day', CAST(last_run_time AS DATE), DATE '2024-03-01') AS days_since_run
FROM newest WHERE last_run_time < TIMESTAMP '2024-03-01' - INTERVAL 30 DAY""")
def rep_jobs_not_run_30d(t):
    """Seen from a month past the data, so that some jobs qualify."""
    return jobs_not_run(t, "2024-03-01")


def jobs_not_run(t, as_of: str):
    """Jobs whose newest slice is over 30 days old."""
    newest = t.run_timeline.where(since("period_start_time", f"{as_of} 00:00:00", 365)).groupBy("job_id").agg(
        F.max("period_start_time").alias("last_run_time"))
    return newest.where(~since("last_run_time", f"{as_of} 00:00:00", 30)).withColumn(
        "days_since_run", F.datediff(F.to_date(F.lit(as_of)), F.to_date("last_run_time")).cast("long")
    ).orderBy("last_run_time")


@query("rep_pipeline_health", views=TIMELINE, sql=f"""
SELECT group_id AS pipeline_id, count(DISTINCT run_id) AS update_count,
       count(*) FILTER (result_state = 'SUCCESS') AS success_count,
       count(*) FILTER (result_state = 'FAILED') AS failed_count,
       round(100.0 * count(*) FILTER (result_state = 'FAILED') / CAST(count(*) AS DOUBLE), 2) AS failure_rate_pct
FROM run_timeline WHERE {LAST.format(14)} AND result_state IS NOT NULL
GROUP BY 1 ORDER BY failed_count DESC, update_count DESC, 1 LIMIT 50""")
def rep_pipeline_health(t):
    failed = count_where(is_failed())
    return recent(t, 14).where("result_state IS NOT NULL").groupBy(F.col("group_id").alias("pipeline_id")).agg(
        F.countDistinct("run_id").alias("update_count"), count_where(is_success()).alias("success_count"),
        failed.alias("failed_count"), rate_pct(failed, F.count("*")).alias("failure_rate_pct"),
    ).orderBy(F.desc("failed_count"), F.desc("update_count"), "pipeline_id").limit(50)


@query("rep_job_duration_percentiles", views=TIMELINE, sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(30))}
SELECT job_id, count(*) AS run_count,
       CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY duration_sec) AS DOUBLE) AS p50_sec,
       CAST(percentile_disc(0.9) WITHIN GROUP (ORDER BY duration_sec) AS DOUBLE) AS p90_sec,
       round(CAST(sum(duration_sec) AS BIGINT) / CAST(count(*) AS DOUBLE), 1) AS avg_sec
FROM runs WHERE result_state = 'SUCCESS' GROUP BY job_id HAVING count(*) >= 5
ORDER BY p90_sec DESC, job_id LIMIT 50""")
def rep_job_duration_percentiles(t):
    good = runs(recent(t, 30)).where(is_success())
    found = discrete_percentiles(good, ["job_id"], "duration_sec", {"p50": 0.5, "p90": 0.9})
    return good.groupBy("job_id").agg(F.count("*").alias("run_count"), F.round(F.avg("duration_sec"), 1).alias("avg_sec")).where(
        "run_count >= 5").join(found, "job_id").select(
        "job_id", "run_count", F.col("p50").cast("double").alias("p50_sec"), F.col("p90").cast("double").alias("p90_sec"), "avg_sec",
    ).orderBy(F.desc("p90_sec"), "job_id").limit(50)


@query("rep_warehouse_events", views=TIMELINE, sql=f"""
SELECT slice_id, job_id AS warehouse_id, trigger_type AS event_type, period_start_time AS event_time,
       slice_sec % 10 AS cluster_count
FROM run_timeline WHERE {LAST.format(7)} ORDER BY event_time DESC, slice_id LIMIT 200""")
def rep_warehouse_events(t):
    """Start and stop events, newest first; the timeline stands in for the event table."""
    return recent(t, 7).orderBy(F.desc("period_start_time"), "slice_id").limit(200).select(
        "slice_id", F.col("job_id").alias("warehouse_id"), F.col("trigger_type").alias("event_type"),
        F.col("period_start_time").alias("event_time"), (F.col("slice_sec") % 10).alias("cluster_count"))


@query("rep_retried_runs", views=TIMELINE, sql=f"""
SELECT job_id, run_id, count(*) AS retry_or_failure_count
FROM run_timeline WHERE {LAST.format(14)} AND result_state = 'FAILED' GROUP BY ALL
ORDER BY retry_or_failure_count DESC, job_id, run_id LIMIT 50""")
def rep_retried_runs(t):
    """Failed slices per run (each failed slice counts)."""
    return recent(t, 14).where(is_failed()).groupBy("job_id", "run_id").agg(
        F.count("*").alias("retry_or_failure_count")
    ).orderBy(F.desc("retry_or_failure_count"), "job_id", "run_id").limit(50)


@query("rep_jobs_by_trigger", views=TIMELINE, sql=f"""
SELECT trigger_type, count(DISTINCT run_id) AS run_count FROM run_timeline WHERE {LAST.format(14)} GROUP BY 1""")
def rep_jobs_by_trigger(t):
    return recent(t, 14).groupBy("trigger_type").agg(F.countDistinct("run_id").alias("run_count")).orderBy(
        F.desc("run_count"))


@query("rep_failing_jobs_unused_output", views=("run_timeline", "table_lineage"), sql=f"""
WITH {RUNS_SQL.format(last=LAST.format(14))},
outcome AS (SELECT job_id, count(*) AS total_runs, count(*) FILTER (result_state = 'FAILED') AS failed_runs
            FROM runs GROUP BY job_id HAVING count(*) FILTER (result_state = 'FAILED') >= 1),
written AS (SELECT DISTINCT entity_id, target_table_full_name AS name FROM table_lineage
            WHERE entity_type = 'JOB' AND target_table_full_name IS NOT NULL AND event_date >= DATE '2001-08-01' - INTERVAL 90 DAY),
unused AS (SELECT entity_id, count(*) AS unused_count FROM written
           WHERE name NOT IN (SELECT source_table_full_name FROM table_lineage
                              WHERE source_table_full_name IS NOT NULL AND event_date >= DATE '2001-08-01' - INTERVAL 90 DAY)
           GROUP BY 1)
SELECT job_id, total_runs, failed_runs, round(100.0 * failed_runs / CAST(total_runs AS DOUBLE), 1) AS failure_rate_pct,
       coalesce(unused_count, 0) AS unused_tables_created
FROM outcome LEFT JOIN unused ON CAST(job_id AS VARCHAR) = CAST(entity_id AS VARCHAR)
ORDER BY failure_rate_pct DESC, unused_tables_created DESC, job_id LIMIT 30""")
def rep_failing_jobs_unused_output(t):
    return failing_jobs_unused_output(t)


def failing_jobs_unused_output(t, written_days: int = 90, read_days: int = 90):
    """Failing jobs with the number of tables they wrote that nobody read."""
    from lakejobs.plans.lineage_reports import recent_edges, written_unread

    outcome = runs(recent(t, 14)).groupBy("job_id").agg(
        F.count("*").alias("total_runs"), count_where(is_failed()).alias("failed_runs")).where("failed_runs >= 1")
    by_jobs = recent_edges(t, written_days).where("entity_type = 'JOB'")
    unused = written_unread(by_jobs, recent_edges(t, read_days), ["entity_id"]).groupBy("entity_id").agg(
        F.count("*").alias("unused_count"))
    same = F.col("job_id").cast("string") == F.col("entity_id").cast("string")
    return outcome.join(unused, same, "left").select(
        "job_id", "total_runs", "failed_runs", rate_pct(F.col("failed_runs"), F.col("total_runs"), 1).alias("failure_rate_pct"),
        F.coalesce("unused_count", F.lit(0)).cast("long").alias("unused_tables_created"),
    ).orderBy(F.desc("failure_rate_pct"), F.desc("unused_tables_created"), "job_id").limit(30)
