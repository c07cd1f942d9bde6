"""Reports over the audit log view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.registry import query

AUDIT = ("audit",)
MONTH_SQL = 'CAST(month(event_date) AS INTEGER) AS "month", CAST(year(event_date) AS INTEGER) AS "year"'


def month_year():
    return F.month("event_date").alias("month"), F.year("event_date").alias("year")


def action_counts(audit, action: str, name: str, *more: str, service: str | None = None):
    """Events of one action per user (and ``more``), month and year."""
    rows = audit.where(F.col("action_name") == action)
    if service:
        rows = rows.where(F.col("service_name") == service)
    return rows.groupBy("email", *more, *month_year()).agg(F.count("*").alias(name))


def action_counts_sql(action: str, name: str, *more: str, service: str | None = None) -> str:
    columns = "".join(f", {c}" for c in more)
    extra = f" AND service_name = '{service}'" if service else ""
    return f"""
SELECT email{columns}, {MONTH_SQL}, count(*) AS {name} FROM audit
WHERE action_name = '{action}'{extra} GROUP BY ALL"""


def _register_counts(key: str, action: str, name: str, *more: str, service: str | None = None) -> None:
    query(key, views=AUDIT, sql=action_counts_sql(action, name, *more, service=service))(
        lambda t: action_counts(t.audit, action, name, *more, service=service))


_register_counts("rep_audit_catalogs_created", "createCatalog", "nbr_catalog", "status_code")
_register_counts("rep_audit_tables_created", "createTable", "nbr_table", "status_code")
_register_counts("rep_audit_notebooks_created", "createNotebook", "nbr_notebook")
_register_counts("rep_audit_commands_run", "runCommand", "nbr_command")
_register_counts("rep_audit_clusters_created", "create", "nbr_clusters")
_register_counts("rep_audit_tokens", "generateToken", "nbr_token", service="accounts")


@query("rep_audit_by_service", views=AUDIT, sql="SELECT * FROM audit WHERE service_name = 'accounts'")
def rep_audit_by_service(t, service: str = "accounts"):
    return t.audit.where(F.col("service_name") == service)


@query("rep_audit_command_time", views=AUDIT, sql=f"""
SELECT email, command_language, status, {MONTH_SQL}, CAST(sum(execution_ms) AS BIGINT) AS duration
FROM audit WHERE action_name = 'runCommand' GROUP BY ALL""")
def rep_audit_command_time(t):
    return t.audit.where("action_name = 'runCommand'").groupBy(
        "email", "command_language", "status", *month_year()).agg(F.sum("execution_ms").alias("duration"))


@query("rep_audit_services", views=AUDIT, sql="SELECT DISTINCT service_name FROM audit")
def rep_audit_services(t):
    return t.audit.select("service_name").distinct()


@query("rep_audit_notebook_commands", views=AUDIT, sql="""
SELECT * FROM audit WHERE service_name = 'notebook' AND action_name = 'runCommand'""")
def rep_audit_notebook_commands(t):
    return notebook_commands(t)


def notebook_commands(t):
    return t.audit.where("service_name = 'notebook' AND action_name = 'runCommand'")


def actions_of(t, service: str):
    return t.audit.where(F.col("service_name") == service).select("action_name").distinct()


@query("rep_audit_cluster_actions", views=AUDIT, sql="SELECT DISTINCT action_name FROM audit WHERE service_name = 'clusters'")
def rep_audit_cluster_actions(t):
    return actions_of(t, "clusters")


@query("rep_audit_catalog_actions", views=AUDIT, sql="SELECT DISTINCT action_name FROM audit WHERE service_name = 'catalog'")
def rep_audit_catalog_actions(t):
    return actions_of(t, "catalog")


@query("rep_command_usage", views=AUDIT, sql="""
SELECT event_id, email, command_language, execution_ms, status FROM audit
WHERE service_name = 'notebook' AND action_name = 'runCommand'""")
def rep_command_usage(t):
    return notebook_commands(t).select("event_id", "email", "command_language", "execution_ms", "status")


@query("rep_user_duration_top10", views=AUDIT, sql="""
SELECT email, CAST(sum(execution_ms) AS BIGINT) AS duration FROM audit
WHERE service_name = 'notebook' AND action_name = 'runCommand' GROUP BY 1 ORDER BY duration DESC, email LIMIT 10""")
def rep_user_duration_top10(t):
    return notebook_commands(t).groupBy("email").agg(F.sum("execution_ms").alias("duration")).orderBy(
        F.desc("duration"), "email").limit(10)


@query("rep_job_success_details", views=AUDIT, sql="""
SELECT event_id, email, concat('owner', CAST(workspace_id AS VARCHAR)) AS creator, job_id, trigger_type FROM audit
WHERE service_name = 'jobs' AND action_name = 'runSucceeded'""")
def rep_job_success_details(t):
    return t.audit.where("service_name = 'jobs' AND action_name = 'runSucceeded'").select(
        "event_id", "email", F.concat(F.lit("owner"), F.col("workspace_id").cast("string")).alias("creator"), "job_id",
        "trigger_type")


@query("rep_table_access", views=AUDIT, sql="""
SELECT event_id, event_date, email, full_name_arg, workspace_id, action_name FROM audit
WHERE service_name = 'catalog' AND action_name IN ('createTable', 'getTable', 'deleteTable')""")
def rep_table_access(t):
    return t.audit.where(
        (F.col("service_name") == "catalog") & F.col("action_name").isin("createTable", "getTable", "deleteTable")
    ).select("event_id", "event_date", "email", "full_name_arg", "workspace_id", "action_name")


ACCOUNT = "audit_level = 'ACCOUNT_LEVEL' AND service_name = 'accounts' AND action_name = '{}'"


@query("rep_account_user_adds", views=AUDIT, sql=f"""
SELECT event_id, email, event_time FROM audit WHERE {ACCOUNT.format('add')} ORDER BY event_time DESC, event_id LIMIT 15""")
def rep_account_user_adds(t):
    return t.audit.where(ACCOUNT.format("add")).select("event_id", "email", "event_time").orderBy(
        F.desc("event_time"), "event_id").limit(15)


@query("rep_account_logins", views=AUDIT, sql=f"""
SELECT email, count(*) AS logs FROM audit WHERE {ACCOUNT.format('login')} GROUP BY 1 ORDER BY logs DESC, email LIMIT 15""")
def rep_account_logins(t):
    return t.audit.where(ACCOUNT.format("login")).groupBy("email").agg(F.count("*").alias("logs")).orderBy(
        F.desc("logs"), "email").limit(15)


@query("rep_unique_users", views=AUDIT, sql="SELECT count(DISTINCT email) AS unique_users FROM audit")
def rep_unique_users(t):
    return t.audit.agg(F.countDistinct("email").alias("unique_users"))


@query("rep_notebook_creators", views=AUDIT, sql="""
SELECT email, count(*) AS nbr FROM audit WHERE service_name = 'notebook' AND action_name = 'createNotebook'
GROUP BY 1 ORDER BY nbr DESC, email LIMIT 10""")
def rep_notebook_creators(t):
    return t.audit.where("service_name = 'notebook' AND action_name = 'createNotebook'").groupBy("email").agg(
        F.count("*").alias("nbr")).orderBy(F.desc("nbr"), "email").limit(10)
