"""Input tables and the derived views the report queries read.

A view is one SELECT text over base tables that Spark and the oracle engine
both accept, so a report and its oracle start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Reference instants of the look-back reports (the last day the test data covers).
USAGE_AS_OF = "2001-11-04"
LINEAGE_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"


@dataclass(frozen=True)
class View:
    text: str
    reads: tuple[str, ...]

    def oracle_text(self) -> str:
        return self.text.format(**{name: name for name in self.reads}).strip()

    def build(self, tables: "Tables") -> DataFrame:
        inputs = {name: getattr(tables, name) for name in self.reads}
        return tables.spark.sql(self.text, **inputs)


VIEWS: dict[str, View] = {
    "usage": View(
        """
SELECT l.l_shipdate AS usage_start_time, CAST(l.l_shipdate AS DATE) AS usage_date, p.p_brand AS sku_name, p.p_type AS usage_unit,
       CASE l.l_linenumber WHEN 1 THEN 'JOBS' WHEN 2 THEN 'ALL_PURPOSE' WHEN 3 THEN 'SQL'
            WHEN 4 THEN 'DLT' WHEN 5 THEN 'DEFAULT_STORAGE' WHEN 6 THEN 'MODEL_SERVING'
            ELSE 'NETWORK' END AS billing_origin_product,
       l.l_suppkey AS workspace_id,
       CAST(l.l_quantity AS DECIMAL(18,2)) AS usage_quantity,
       CASE WHEN l.l_linestatus = 'O' THEN 'ORIGINAL' ELSE 'RETRACTION' END AS record_type,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_orderkey END AS job_id,
       CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_suppkey % 40 END AS cluster_id,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE l.l_partkey END AS warehouse_id,
       CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_partkey % 60 END AS run_as,
       CASE WHEN l.l_orderkey % 3 = 0 THEN NULL ELSE concat('team', CAST(l.l_orderkey % 7 AS VARCHAR(10))) END AS tag_team,
       CASE WHEN l.l_orderkey % 4 = 0 THEN NULL ELSE concat('cc', CAST(l.l_partkey % 5 AS VARCHAR(10))) END AS tag_cost_center,
       CASE WHEN l.l_orderkey % 6 = 0 THEN NULL WHEN l.l_tax > 0.04 THEN 'prod' ELSE 'dev' END AS tag_env
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
""",
        ("lineitem", "part"),
    ),
    "list_prices": View(
        """
SELECT p_brand AS sku_name, p_type AS usage_unit, p_partkey AS price_id,
       CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price, p_size AS price_start_day,
       CASE WHEN p_partkey % 11 = 0 THEN DATE '2001-06-30' ELSE DATE '2099-12-31' END AS price_end_date
FROM {part}
""",
        ("part",),
    ),
    "query_history": View(
        """
SELECT event_id AS statement_id, ts AS start_time, user_id AS executed_by,
       CASE WHEN event_id % 9 = 0 THEN user_id + 1000 ELSE user_id END AS executed_as,
       CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELED' ELSE 'FINISHED' END AS execution_status,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS client_application,
       CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 499 = 3 THEN 1000 + event_id % 60 ELSE user_id % 10 END AS warehouse_id,
       user_id % 3 AS workspace_id, user_id % 2 AS account_id,
       CAST(round(value * 1000) AS BIGINT) * CASE WHEN event_id % 50 = 0 THEN 20 ELSE 1 END AS total_duration_ms,
       CAST(round(value * 1000) AS BIGINT) % 7000 AS compilation_duration_ms,
       CAST(round(value * 1000) AS BIGINT) - CAST(round(value * 1000) AS BIGINT) % 7000 AS execution_duration_ms,
       CASE WHEN event_id % 4 = 0 THEN CAST(round(value * 1000) AS BIGINT) % 9000 ELSE 0 END AS waiting_at_capacity_ms,
       CASE WHEN event_id % 5 = 1 THEN CAST(round(value * 1000) AS BIGINT) % 11000 ELSE 0 END AS waiting_for_compute_ms,
       CAST(round(value * 10) AS BIGINT) * 3 AS result_fetch_ms,
       CAST(round(value * 100) AS BIGINT) * 40000 AS read_bytes,
       CAST(round(value * 100) AS BIGINT) * 7 AS read_rows,
       event_id % 40 AS read_files, event_id % 90 AS pruned_files,
       CASE WHEN event_id % 3 = 0 THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END AS written_rows,
       CASE WHEN event_id % 3 = 0 THEN CAST(round(value * 100) AS BIGINT) * 900 ELSE 0 END AS written_bytes,
       CASE WHEN event_id % 5 = 0 THEN CAST(round(value * 100) AS BIGINT) * 50000 ELSE 0 END AS spilled_local_bytes,
       event_id % 4 AS produced_rows, event_id % 101 AS read_io_cache_percent,
       event_id % 2 = 0 AS from_result_cache,
       CASE WHEN event_id % 10 = 3 THEN NULL ELSE ts END AS end_time,
       CASE WHEN event_id % 6 = 0 THEN event_id % 20 END AS alert_id,
       CASE WHEN event_id % 6 = 1 THEN event_id % 35 END AS dashboard_id,
       CASE WHEN event_id % 6 = 2 THEN event_id % 45 END AS notebook_id,
       CASE WHEN event_id % 6 = 3 THEN user_id END AS job_id,
       CASE WHEN event_id % 7 = 0 THEN concat('team', CAST(user_id % 5 AS VARCHAR(10))) END AS tag_team,
       CASE WHEN event_id % 8 = 0 THEN concat('proj', CAST(user_id % 4 AS VARCHAR(10))) END AS tag_project,
       concat('SELECT value FROM events WHERE props = ', props) AS statement_text,
       CASE WHEN event_type <> 'error' OR event_id % 8 = 7 THEN NULL
            WHEN event_id % 8 = 0 THEN 'User has insufficient SELECT privileges'
            WHEN event_id % 8 = 1 THEN 'Permission was denied on schema'
            WHEN event_id % 8 = 2 THEN concat('Table t', CAST(event_id % 30 AS VARCHAR(10)), ' was not found')
            WHEN event_id % 8 = 3 THEN 'Path does not exist: /in'
            WHEN event_id % 8 = 4 THEN 'Division by zero'
            ELSE concat('Cannot resolve column c', CAST(event_id % 12 AS VARCHAR(10))) END AS error_message
FROM {events}
""",
        ("events",),
    ),
    "table_lineage": View(
        """
SELECT CASE WHEN o_orderstatus = 'F' THEN NULL
            ELSE concat('main.s', CAST(o_custkey % 97 % 5 AS VARCHAR(10)), '.t', CAST(o_custkey % 97 AS VARCHAR(10))) END AS source_table_full_name,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE concat('main.s', CAST(o_orderkey % 131 % 5 AS VARCHAR(10)), '.t', CAST(o_orderkey % 131 AS VARCHAR(10))) END AS target_table_full_name,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'JOB' ELSE o_orderpriority END AS entity_type,
       o_custkey AS entity_id, o_custkey % 50 AS created_by,
       CASE WHEN o_orderkey % 131 >= 121 THEN o_orderdate - INTERVAL '200' DAY ELSE o_orderdate END AS event_time,
       CAST(CASE WHEN o_orderkey % 131 >= 121 THEN o_orderdate - INTERVAL '200' DAY ELSE o_orderdate END AS DATE) AS event_date
FROM {orders}
""",
        ("orders",),
    ),
    "run_timeline": View(
        """
SELECT event_id AS slice_id, user_id % 7 AS workspace_id, user_id AS job_id, user_id % 30 AS group_id,
       user_id * 100 + EXTRACT(DAY FROM ts) AS run_id, ts AS period_start_time,
       CAST(round(value) AS BIGINT) AS slice_sec, event_type AS trigger_type,
       CASE WHEN event_type = 'error' OR event_type = 'purchase' AND user_id % 20 = 7 THEN 'FAILED' WHEN event_type = 'purchase' THEN 'SUCCESS' END AS result_state
FROM {events}
""",
        ("events",),
    ),
    "audit": View(
        """
SELECT event_id, concat('user', CAST(user_id AS VARCHAR(10)), '@example.com') AS email,
       CASE event_id % 11 WHEN 0 THEN 'runCommand' WHEN 1 THEN 'createNotebook' WHEN 2 THEN 'createCatalog'
            WHEN 3 THEN 'createTable' WHEN 4 THEN 'getTable' WHEN 5 THEN 'create' WHEN 6 THEN 'resize'
            WHEN 7 THEN 'generateToken' WHEN 8 THEN 'login' WHEN 9 THEN 'add' ELSE 'runSucceeded' END AS action_name,
       CASE WHEN event_id % 11 < 2 THEN 'notebook' WHEN event_id % 11 < 5 THEN 'catalog' WHEN event_id % 11 < 7 THEN 'clusters'
            WHEN event_id % 11 < 10 THEN 'accounts' ELSE 'jobs' END AS service_name,
       CASE WHEN event_id % 11 IN (8, 9) AND user_id % 4 <> 0 THEN 'ACCOUNT_LEVEL' ELSE 'WORKSPACE_LEVEL' END AS audit_level,
       CASE user_id % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'sql' ELSE 'scala' END AS command_language,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'finished' END AS status,
       CASE WHEN event_type = 'error' THEN 403 ELSE 200 END AS status_code,
       concat('main.s', CAST(user_id % 5 AS VARCHAR(10)), '.t', CAST(user_id % 97 AS VARCHAR(10))) AS full_name_arg,
       user_id % 3 AS workspace_id, user_id AS job_id, event_type AS trigger_type,
       ts AS event_time, CAST(ts AS DATE) AS event_date, CAST(round(value * 100) AS BIGINT) AS execution_ms
FROM {events}
""",
        ("events",),
    ),
    "matches": View(
        """
SELECT o.o_orderkey AS match_id, CAST(o.o_orderdate AS DATE) AS match_date,
       c.c_nationkey AS home_team, CAST(o.o_orderkey % 25 AS INT) AS away_team,
       CAST(floor(o.o_totalprice) AS BIGINT) % 5 AS home_score, CAST(floor(o.o_totalprice) AS BIGINT) % 4 AS away_score,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'FIFA World Cup' WHEN '2-HIGH' THEN 'FIFA World Cup qualification'
            WHEN '3-MEDIUM' THEN 'Copa América' WHEN '4-NOT SPECIFIED' THEN 'UEFA Nations League' ELSE 'Friendly' END AS tournament
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
WHERE c.c_nationkey <> o.o_orderkey % 25
""",
        ("orders", "customer"),
    ),
    "catalog_tables": View(
        """
SELECT CASE WHEN p_size % 3 > 0 THEN 'main' ELSE 'dev' END AS table_catalog,
       concat('s', CAST(p_partkey % 131 % 5 AS VARCHAR(10))) AS table_schema,
       concat('t', CAST(p_partkey % 131 AS VARCHAR(10))) AS table_name,
       CASE WHEN p_size % 5 = 0 THEN 'VIEW' WHEN p_size % 5 = 1 THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type
FROM {part}
""",
        ("part",),
    ),
}


class Tables:
    """Attribute access to base tables and views of one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._loaded: dict[str, DataFrame] = {}
        self._made: dict[str, Any] = {}

    def once(self, name: str, make: Callable[[], Any]) -> Any:
        """What ``make`` returns, made once for these tables: for steps that several parts of a query share."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._loaded:
            if name in BASE_TABLES:
                self._loaded[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
            elif name in VIEWS:
                self._loaded[name] = VIEWS[name].build(self)
            else:
                raise AttributeError(name)
        return self._loaded[name]
