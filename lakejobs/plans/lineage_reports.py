"""Reports over table lineage edges and the table catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.relational import anti, distinct_values, since, sorted_set
from lakejobs.registry import query
from lakejobs.session import written
from lakejobs.tables import LINEAGE_AS_OF

LINEAGE = ("table_lineage",)
DAY0 = f"{LINEAGE_AS_OF} 00:00:00"
LAST = "event_date >= DATE '2001-08-01' - INTERVAL {} DAY"
SOURCE, TARGET = "source_table_full_name", "target_table_full_name"


def recent_edges(t, days: int) -> DataFrame:
    return t.table_lineage.where(since("event_time", DAY0, days))


def names_of(edges: DataFrame, *sides: str) -> DataFrame:
    return distinct_values(edges, list(sides), "table_full_name")


def written_unread(written: DataFrame, read: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Distinct written tables (with ``extra`` keys) that are no source in ``read``."""
    targets = written.where(F.col(TARGET).isNotNull()).select(
        *(extra or []), F.col(TARGET).alias("table_full_name")).distinct()
    return anti(targets, names_of(read, SOURCE), ["table_full_name"])


def _with_reason(tables: DataFrame, reason: str) -> DataFrame:
    return tables.select("table_full_name", F.lit(reason).alias("reason")).orderBy("table_full_name")


ALL_NAMES_SQL = """known AS (SELECT source_table_full_name AS n FROM table_lineage WHERE source_table_full_name IS NOT NULL
  UNION SELECT target_table_full_name FROM table_lineage WHERE target_table_full_name IS NOT NULL)"""


@query("rep_tables_no_recent_reads", views=LINEAGE, sql=f"""
WITH {ALL_NAMES_SQL}
SELECT n AS table_full_name, 'no_reads_last_90d' AS reason FROM known
WHERE NOT EXISTS (SELECT 1 FROM table_lineage WHERE source_table_full_name = n AND {LAST.format(90)})""")
def rep_tables_no_recent_reads(t):
    known = names_of(t.table_lineage, SOURCE, TARGET)
    return _with_reason(anti(known, names_of(recent_edges(t, 90), SOURCE), ["table_full_name"]), "no_reads_last_90d")


@query("rep_cold_tables", views=LINEAGE, sql=f"""
WITH {ALL_NAMES_SQL}
SELECT n AS table_full_name, 'no_activity_90d' AS reason FROM known
WHERE NOT EXISTS (SELECT 1 FROM table_lineage WHERE {LAST.format(90)}
                  AND (source_table_full_name = n OR target_table_full_name = n))""")
def rep_cold_tables(t):
    return cold_tables(t)


def cold_tables(t, days: int = 90):
    """Tables neither read nor written in the last ``days`` days."""
    known = names_of(t.table_lineage, SOURCE, TARGET)
    active = names_of(recent_edges(t, days), SOURCE, TARGET)
    return _with_reason(anti(known, active, ["table_full_name"]), f"no_activity_{days}d")


@query("rep_unused_tables_catalog_schema", views=("catalog_tables", "table_lineage"), sql=f"""
WITH used AS (SELECT source_table_full_name AS n FROM table_lineage WHERE {LAST.format(90)}
              UNION SELECT target_table_full_name FROM table_lineage WHERE {LAST.format(90)}),
named AS (SELECT *, table_catalog || '.' || table_schema || '.' || table_name AS full_name FROM catalog_tables)
SELECT table_catalog, table_schema, table_name, full_name,
       CASE WHEN full_name IN (SELECT n FROM used WHERE n IS NOT NULL) THEN 'used' ELSE 'no_lineage_90d' END AS usage_status
FROM named WHERE table_schema NOT IN ('information_schema', 'system') AND table_type IN ('MANAGED', 'EXTERNAL')""")
def rep_unused_tables_catalog_schema(t):
    used = names_of(recent_edges(t, 90), SOURCE, TARGET).select(
        F.col("table_full_name").alias("full_name"), F.lit(True).alias("_used"))
    full_name = F.concat_ws(".", "table_catalog", "table_schema", "table_name").alias("full_name")
    own = t.catalog_tables.where(
        ~F.col("table_schema").isin("information_schema", "system") & F.col("table_type").isin("MANAGED", "EXTERNAL")
    ).select("table_catalog", "table_schema", "table_name", full_name)
    status = F.when(F.col("_used"), "used").otherwise("no_lineage_90d").alias("usage_status")
    return own.join(used, "full_name", "left").select(
        "table_catalog", "table_schema", "table_name", "full_name", status).orderBy("usage_status", "full_name")


@query("rep_lineage_downstream_consumers", views=LINEAGE, sql=f"""
SELECT source_table_full_name, count(DISTINCT target_table_full_name) AS downstream_count,
       list_sort(list(DISTINCT entity_type)) AS consumer_types
FROM table_lineage WHERE source_table_full_name IS NOT NULL AND target_table_full_name IS NOT NULL AND {LAST.format(90)}
GROUP BY 1 ORDER BY downstream_count DESC, 1 LIMIT 100""")
def rep_lineage_downstream_consumers(t):
    both = F.col(SOURCE).isNotNull() & F.col(TARGET).isNotNull()
    return recent_edges(t, 90).where(both).groupBy(SOURCE).agg(
        F.countDistinct(TARGET).alias("downstream_count"), sorted_set("entity_type").alias("consumer_types")
    ).orderBy(F.desc("downstream_count"), SOURCE).limit(100)


def _most_users(t, side: str, name: str) -> DataFrame:
    return recent_edges(t, 90).where(F.col(side).isNotNull()).groupBy(side).agg(
        F.countDistinct("entity_id").alias(name), F.countDistinct("created_by").alias("distinct_users"),
        sorted_set("entity_type").alias("entity_types"),
    ).orderBy(F.desc(name), side).limit(50)


def _most_users_sql(side: str, name: str) -> str:
    return f"""
SELECT {side}, count(DISTINCT entity_id) AS {name}, count(DISTINCT created_by) AS distinct_users,
       list_sort(list(DISTINCT entity_type)) AS entity_types
FROM table_lineage WHERE {side} IS NOT NULL AND {LAST.format(90)} GROUP BY 1 ORDER BY {name} DESC, 1 LIMIT 50"""


@query("rep_lineage_most_readers", views=LINEAGE, sql=_most_users_sql(SOURCE, "reader_count"))
def rep_lineage_most_readers(t):
    return _most_users(t, SOURCE, "reader_count")


@query("rep_lineage_most_writers", views=LINEAGE, sql=_most_users_sql(TARGET, "writer_count"))
def rep_lineage_most_writers(t):
    return _most_users(t, TARGET, "writer_count")


@query("rep_stale_tables", views=LINEAGE, sql=f"""
WITH w AS (SELECT target_table_full_name, max(event_time) AS last_write_time FROM table_lineage
           WHERE target_table_full_name IS NOT NULL AND {LAST.format(365)} GROUP BY 1)
SELECT target_table_full_name, last_write_time,
       date_diff('day', CAST(last_write_time AS DATE), DATE '2001-08-01') AS days_since_write
FROM w WHERE last_write_time < TIMESTAMP '2001-08-01' - INTERVAL 90 DAY""")
def rep_stale_tables(t):
    return stale_tables(t)


def stale_tables(t, stale_days: int = 90):
    written = recent_edges(t, 365).where(F.col(TARGET).isNotNull()).groupBy(TARGET).agg(
        F.max("event_time").alias("last_write_time"))
    return written.where(~since("last_write_time", DAY0, stale_days)).withColumn(
        "days_since_write", _days_since("last_write_time")).orderBy("last_write_time")


def _days_since(column: str):
    return F.datediff(F.to_date(F.lit(LINEAGE_AS_OF)), F.to_date(column)).cast("long")


UNREAD_SQL = """SELECT DISTINCT target_table_full_name AS table_full_name FROM table_lineage
WHERE target_table_full_name IS NOT NULL AND {written} AND target_table_full_name NOT IN (
  SELECT source_table_full_name FROM table_lineage WHERE source_table_full_name IS NOT NULL AND {read})"""


@query("rep_tables_no_downstream", views=LINEAGE, sql=f"""
SELECT table_full_name, 'no_downstream_reads_90d' AS reason
FROM ({UNREAD_SQL.format(written=LAST.format(90), read=LAST.format(90))}) ORDER BY table_full_name LIMIT 200""")
def rep_tables_no_downstream(t):
    recent = recent_edges(t, 90)
    return _with_reason(written_unread(recent, recent), "no_downstream_reads_90d").limit(200)


@query("rep_orphan_writes", views=LINEAGE, sql=f"""
SELECT table_full_name, 'written_never_read_90d' AS reason
FROM ({UNREAD_SQL.format(written=LAST.format(90), read=LAST.format(90))}) ORDER BY table_full_name LIMIT 200""")
def rep_orphan_writes(t):
    recent = recent_edges(t, 90)
    return _with_reason(written_unread(recent, recent), "written_never_read_90d").limit(200)


@query("rep_lineage_by_entity_type", views=LINEAGE, sql=f"""
SELECT entity_type, count(*) AS lineage_event_count FROM table_lineage WHERE {LAST.format(30)} GROUP BY 1""")
def rep_lineage_by_entity_type(t):
    return recent_edges(t, 30).groupBy("entity_type").agg(F.count("*").alias("lineage_event_count")).orderBy(
        F.desc("lineage_event_count"))


def _most_events(t, side: str, name: str) -> DataFrame:
    return recent_edges(t, 30).where(F.col(side).isNotNull()).groupBy(side).agg(F.count("*").alias(name)).orderBy(
        F.desc(name), side).limit(50)


def _most_events_sql(side: str, name: str) -> str:
    return f"""
SELECT {side}, count(*) AS {name} FROM table_lineage WHERE {side} IS NOT NULL AND {LAST.format(30)}
GROUP BY 1 ORDER BY {name} DESC, 1 LIMIT 50"""


@query("rep_most_read_tables", views=LINEAGE, sql=_most_events_sql(SOURCE, "read_event_count"))
def rep_most_read_tables(t):
    return _most_events(t, SOURCE, "read_event_count")


@query("rep_most_written_tables", views=LINEAGE, sql=_most_events_sql(TARGET, "write_event_count"))
def rep_most_written_tables(t):
    return _most_events(t, TARGET, "write_event_count")


def _lists_of_first(pairs, key, item, count, items, n=50):
    """The ``n`` keys with most items and their lists: counted first, so only the lists that are shown are collected."""
    top = pairs.groupBy(key).agg(F.count("*").alias(count)).orderBy(F.desc(count), key).limit(n)
    return pairs.join(top, key).groupBy(key, count).agg(F.array_sort(F.collect_list(item)).alias(items)).orderBy(F.desc(count), key)


@query("rep_jobs_unused_tables", views=LINEAGE, sql=f"""
WITH w AS (SELECT DISTINCT entity_id, target_table_full_name AS n FROM table_lineage
           WHERE entity_type = 'JOB' AND target_table_full_name IS NOT NULL AND {LAST.format(90)})
SELECT entity_id AS job_id, count(*) AS unused_table_count, list_sort(list(n)) AS unused_tables
FROM w WHERE n NOT IN (SELECT source_table_full_name FROM table_lineage
                       WHERE source_table_full_name IS NOT NULL AND {LAST.format(90)})
GROUP BY 1 ORDER BY unused_table_count DESC, 1 LIMIT 50""")
def rep_jobs_unused_tables(t):
    recent = recent_edges(t, 90)
    unused = written(written_unread(recent.where("entity_type = 'JOB'"), recent, ["entity_id"]).select(
        F.col("entity_id").alias("job_id"), "table_full_name"))
    return _lists_of_first(unused, "job_id", "table_full_name", "unused_table_count", "unused_tables")


@query("rep_unused_tables_last_write", views=LINEAGE, sql=f"""
WITH u AS ({UNREAD_SQL.format(written=LAST.format(90), read=LAST.format(90))}),
w AS (SELECT target_table_full_name AS table_full_name, max(event_time) AS last_write_time FROM table_lineage
      WHERE {LAST.format(365)} GROUP BY 1)
SELECT table_full_name, last_write_time, date_diff('day', CAST(last_write_time AS DATE), DATE '2001-08-01') AS days_since_write,
       'no_reads_90d' AS reason
FROM u JOIN w USING (table_full_name) ORDER BY days_since_write DESC, table_full_name LIMIT 200""")
def rep_unused_tables_last_write(t):
    """A table written in the last 90 days has its last write there too, so one aggregate serves both."""
    recent = recent_edges(t, 90)
    written = recent.where(F.col(TARGET).isNotNull()).groupBy(F.col(TARGET).alias("table_full_name")).agg(
        F.max("event_time").alias("last_write_time"))
    return anti(written, names_of(recent, SOURCE), ["table_full_name"]).select(
        "table_full_name", "last_write_time", _days_since("last_write_time").alias("days_since_write"),
        F.lit("no_reads_90d").alias("reason"),
    ).orderBy(F.desc("days_since_write"), "table_full_name").limit(200)


def _access(t, side: str, prefix: str) -> DataFrame:
    return recent_edges(t, 30).where(F.col(side).isNotNull()).groupBy(F.col(side).alias("table_full_name")).agg(
        F.count("*").alias(f"{prefix}_events"), F.countDistinct("entity_id").alias(f"{prefix}_entities"),
        F.countDistinct("created_by").alias(f"{prefix}_users"))


def _zero(column: str):
    return F.coalesce(column, F.lit(0)).cast("long")


ACCESS_SQL = f"""
r AS (SELECT source_table_full_name AS n, count(*) AS ev, count(DISTINCT entity_id) AS en, count(DISTINCT created_by) AS us
      FROM table_lineage WHERE source_table_full_name IS NOT NULL AND {LAST.format(30)} GROUP BY 1),
w AS (SELECT target_table_full_name AS n, count(*) AS ev, count(DISTINCT entity_id) AS en, count(DISTINCT created_by) AS us
      FROM table_lineage WHERE target_table_full_name IS NOT NULL AND {LAST.format(30)} GROUP BY 1)"""


@query("rep_most_accessed_tables", views=LINEAGE, sql=f"""
WITH {ACCESS_SQL}
SELECT coalesce(r.n, w.n) AS table_full_name, coalesce(r.ev, 0) AS read_events, coalesce(w.ev, 0) AS write_events,
       coalesce(r.ev, 0) + coalesce(w.ev, 0) AS total_access_events,
       coalesce(r.us, 0) + coalesce(w.us, 0) AS distinct_users_approx
FROM r FULL JOIN w ON r.n = w.n ORDER BY total_access_events DESC, table_full_name LIMIT 100""")
def rep_most_accessed_tables(t):
    both = _access(t, SOURCE, "read").join(_access(t, TARGET, "write"), "table_full_name", "full")
    return both.select(
        "table_full_name", _zero("read_events").alias("read_events"), _zero("write_events").alias("write_events"),
        (_zero("read_events") + _zero("write_events")).alias("total_access_events"),
        (_zero("read_users") + _zero("write_users")).alias("distinct_users_approx"),
    ).orderBy(F.desc("total_access_events"), "table_full_name").limit(100)


@query("rep_tables_by_entities", views=LINEAGE, sql=f"""
WITH {ACCESS_SQL}
SELECT coalesce(r.n, w.n) AS table_full_name, coalesce(r.en, 0) AS distinct_readers, coalesce(w.en, 0) AS distinct_writers,
       coalesce(r.en, 0) + coalesce(w.en, 0) AS total_distinct_entities
FROM r FULL JOIN w ON r.n = w.n ORDER BY total_distinct_entities DESC, table_full_name LIMIT 100""")
def rep_tables_by_entities(t):
    both = _access(t, SOURCE, "read").join(_access(t, TARGET, "write"), "table_full_name", "full")
    return both.select(
        "table_full_name", _zero("read_entities").alias("distinct_readers"),
        _zero("write_entities").alias("distinct_writers"),
        (_zero("read_entities") + _zero("write_entities")).alias("total_distinct_entities"),
    ).orderBy(F.desc("total_distinct_entities"), "table_full_name").limit(100)


@query("rep_job_table_churn", views=LINEAGE, sql=f"""
SELECT entity_id AS job_entity_id, count(DISTINCT target_table_full_name) AS tables_written,
       list_sort(list(DISTINCT target_table_full_name)) AS table_list
FROM table_lineage WHERE entity_type = 'JOB' AND target_table_full_name IS NOT NULL AND {LAST.format(30)}
GROUP BY 1 ORDER BY tables_written DESC, 1 LIMIT 50""")
def rep_job_table_churn(t):
    """Distinct first, so the lists are built from reduced rows and their sizes are the counts."""
    pairs = written(recent_edges(t, 30).where("entity_type = 'JOB'").where(F.col(TARGET).isNotNull()).select(
        F.col("entity_id").alias("job_entity_id"), TARGET).distinct())
    return _lists_of_first(pairs, "job_entity_id", TARGET, "tables_written", "table_list")


# --- catalogue lists ---------------------------------------------------------

CATALOG = ("catalog_tables",)


@query("rep_tables_not_views", views=CATALOG, sql="SELECT * FROM catalog_tables WHERE table_type NOT IN ('VIEW')")
def rep_tables_not_views(t):
    return t.catalog_tables.where(F.col("table_type") != "VIEW")


@query("rep_tables_all", views=CATALOG, sql="SELECT * FROM catalog_tables")
def rep_tables_all(t):
    return t.catalog_tables


@query("rep_cluster_list", views=CATALOG, sql="SELECT DISTINCT table_catalog, table_schema, table_type FROM catalog_tables")
def rep_cluster_list(t):
    """Listing of an inventory table; the catalogue view stands in for the cluster table."""
    return t.catalog_tables.select("table_catalog", "table_schema", "table_type").distinct()


@query("rep_top_shared_catalogs", views=LINEAGE, sql="""
SELECT split_part(source_table_full_name, '.', 1) AS catalog_name, count(*) AS iteration FROM table_lineage
WHERE source_table_full_name IS NOT NULL GROUP BY 1 ORDER BY iteration DESC, 1 LIMIT 10""")
def rep_top_shared_catalogs(t):
    part = F.split_part(F.col(SOURCE), F.lit("."), F.lit(1)).alias("catalog_name")
    return t.table_lineage.where(F.col(SOURCE).isNotNull()).groupBy(part).agg(F.count("*").alias("iteration")).orderBy(
        F.desc("iteration"), "catalog_name").limit(10)
