"""Cost reports over the usage and price views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.relational import latest_by, since, tag_map
from lakejobs.registry import query
from lakejobs.tables import USAGE_AS_OF

DAY0 = f"{USAGE_AS_OF} 00:00:00"
USAGE = ("usage",)
PRICED = ("usage", "list_prices")

# Oracle fragments: recent net usage, and the newest open price of each sku and unit.
NET = "record_type = 'ORIGINAL' AND usage_date >= DATE '2001-11-04' - INTERVAL {days} DAY"
PRICE_CTE = """price AS (
  SELECT sku_name, usage_unit, unit_price FROM list_prices WHERE price_end_date > DATE '2001-11-04'
  QUALIFY row_number() OVER (PARTITION BY sku_name, usage_unit ORDER BY price_start_day DESC, price_id DESC) = 1
)"""
COST = "CAST(round(sum(CAST(q AS DECIMAL(18,2)) * coalesce(unit_price, 0)), 2) AS DOUBLE)"


def net_usage(usage: DataFrame, days: int) -> DataFrame:
    """Original records of the last ``days`` days; the bound is on the raw time column."""
    return usage.where((F.col("record_type") == "ORIGINAL") & since("usage_start_time", DAY0, days))


def quantity_by(usage: DataFrame, days: int, *keys: str) -> DataFrame:
    return net_usage(usage, days).groupBy(*keys).agg(F.sum("usage_quantity").alias("q"))


def open_prices(prices: DataFrame) -> DataFrame:
    """One row per sku and unit: the newest price that has not ended."""
    live = prices.where(F.col("price_end_date") > F.to_date(F.lit(USAGE_AS_OF)))
    return latest_by(live, ["sku_name", "usage_unit"], ["price_start_day", "price_id"], ["unit_price"])


def with_price(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on the full price key; a missing price costs 0."""
    joined = usage.join(open_prices(prices), ["sku_name", "usage_unit"], "left")
    return joined.withColumn("unit_price", F.coalesce("unit_price", F.lit(0).cast("decimal(18,4)")))


def quantity(name: str = "usage_quantity"):
    return F.col("q").cast("double").alias(name)


def row_cost():
    return F.round(F.col("q") * F.col("unit_price"), 2).cast("double").alias("estimated_cost_usd")


def total_cost():
    return F.round(F.sum(F.col("q") * F.col("unit_price")), 2).cast("double").alias("estimated_cost_usd")


@query("rep_cost_by_product", views=PRICED, sql=f"""
WITH net AS (SELECT usage_date, billing_origin_product, sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE {NET.format(days=30)} GROUP BY ALL), {PRICE_CTE}
SELECT usage_date, billing_origin_product AS product, sku_name, CAST(q AS DOUBLE) AS usage_quantity,
       CAST(coalesce(unit_price, 0) AS DOUBLE) AS unit_price,
       CAST(round(CAST(q AS DECIMAL(18,2)) * coalesce(unit_price, 0), 2) AS DOUBLE) AS estimated_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit)""")
def rep_cost_by_product(t):
    net = quantity_by(t.usage, 30, "usage_date", "billing_origin_product", "sku_name", "usage_unit")
    return with_price(net, t.list_prices).select(
        "usage_date", F.col("billing_origin_product").alias("product"), "sku_name", quantity(),
        F.col("unit_price").cast("double").alias("unit_price"), row_cost(),
    ).orderBy(F.desc("usage_date"), F.desc("estimated_cost_usd"))


@query("rep_cost_by_workspace_sku", views=PRICED, sql=f"""
WITH net AS (SELECT workspace_id, sku_name, usage_unit, billing_origin_product AS product, sum(usage_quantity) AS q
             FROM usage WHERE {NET.format(days=30)} GROUP BY ALL), {PRICE_CTE}
SELECT workspace_id, sku_name, product, CAST(sum(q) AS DOUBLE) AS usage_quantity, {COST} AS estimated_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit) GROUP BY workspace_id, sku_name, product""")
def rep_cost_by_workspace_sku(t):
    net = quantity_by(t.usage, 30, "workspace_id", "sku_name", "usage_unit", "billing_origin_product")
    return with_price(net, t.list_prices).groupBy(
        "workspace_id", "sku_name", F.col("billing_origin_product").alias("product")
    ).agg(F.sum("q").cast("double").alias("usage_quantity"), total_cost()).orderBy(F.desc("estimated_cost_usd"))


@query("rep_cost_by_user", views=USAGE, sql=f"""
SELECT usage_date, run_as AS run_as_user, billing_origin_product AS product, sku_name,
       CAST(sum(usage_quantity) AS DOUBLE) AS usage_quantity
FROM usage WHERE {NET.format(days=30)} AND run_as IS NOT NULL GROUP BY ALL""")
def rep_cost_by_user(t):
    known = t.usage.where(F.col("run_as").isNotNull())
    return quantity_by(known, 30, "usage_date", "run_as", "billing_origin_product", "sku_name").select(
        "usage_date", F.col("run_as").alias("run_as_user"), F.col("billing_origin_product").alias("product"),
        "sku_name", quantity(),
    ).orderBy(F.desc("usage_date"), F.desc("usage_quantity"))


@query("rep_daily_cost_trend", views=PRICED, sql=f"""
WITH net AS (SELECT usage_date, sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE {NET.format(days=90)} GROUP BY ALL), {PRICE_CTE}
SELECT usage_date, {COST} AS estimated_daily_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit) GROUP BY usage_date""")
def rep_daily_cost_trend(t):
    net = quantity_by(t.usage, 90, "usage_date", "sku_name", "usage_unit")
    return with_price(net, t.list_prices).groupBy("usage_date").agg(
        total_cost().alias("estimated_daily_cost_usd")
    ).orderBy(F.desc("usage_date"))


def _top_quantity(t, key: str, limit: int, out: str = "usage_quantity", product: str = "billing_origin_product"):
    """Most used (key, product, sku) groups; the group itself breaks ties."""
    named = t.usage.where(F.col(key).isNotNull())
    return quantity_by(named, 30, key, "billing_origin_product", "sku_name").select(
        key, F.col("billing_origin_product").alias(product), "sku_name", quantity(out)
    ).orderBy(F.desc(out), key, product, "sku_name").limit(limit)


def _top_quantity_sql(key: str, limit: int, out: str = "usage_quantity", product: str = "billing_origin_product"):
    return f"""
SELECT {key}, billing_origin_product AS {product}, sku_name, CAST(sum(usage_quantity) AS DOUBLE) AS {out}
FROM usage WHERE {NET.format(days=30)} AND {key} IS NOT NULL GROUP BY ALL
ORDER BY {out} DESC, {key}, {product}, sku_name LIMIT {limit}"""


@query("rep_top_expensive_jobs", views=USAGE, sql=f"""
SELECT job_id, concat('job', CAST(job_id AS VARCHAR)) AS job_name, billing_origin_product AS product, sku_name,
       CAST(sum(usage_quantity) AS DOUBLE) AS total_usage_quantity
FROM usage WHERE {NET.format(days=30)} AND job_id IS NOT NULL GROUP BY ALL
ORDER BY total_usage_quantity DESC, job_id, product, sku_name LIMIT 50""")
def rep_top_expensive_jobs(t):
    top = _top_quantity(t, "job_id", 50, "total_usage_quantity", "product")
    return top.withColumn("job_name", F.concat(F.lit("job"), F.col("job_id").cast("string")))


@query("rep_cost_cluster", views=USAGE, sql=_top_quantity_sql("cluster_id", 50))
def rep_cost_cluster(t):
    return _top_quantity(t, "cluster_id", 50)


@query("rep_cost_warehouse", views=USAGE, sql=_top_quantity_sql("warehouse_id", 50))
def rep_cost_warehouse(t):
    return _top_quantity(t, "warehouse_id", 50)


@query("rep_cost_custom_tag", views=USAGE, sql=f"""
SELECT usage_date, tag_team, tag_cost_center, tag_env, billing_origin_product,
       CAST(sum(usage_quantity) AS DOUBLE) AS usage_quantity
FROM usage WHERE {NET.format(days=30)} AND coalesce(tag_team, tag_cost_center, tag_env) IS NOT NULL GROUP BY ALL""")
def rep_cost_custom_tag(t):
    tags = tag_map(team="tag_team", cost_center="tag_cost_center", env="tag_env")
    tagged = net_usage(t.usage, 30).withColumn("tags", tags).where(F.size("tags") > 0)
    return tagged.groupBy(
        "usage_date", F.col("tags")["team"].alias("tag_team"), F.col("tags")["cost_center"].alias("tag_cost_center"),
        F.col("tags")["env"].alias("tag_env"), "billing_origin_product",
    ).agg(F.sum("usage_quantity").cast("double").alias("usage_quantity")).orderBy(
        F.desc("usage_date"), F.desc("usage_quantity"))


@query("rep_warehouse_vs_jobs_cost_split", views=USAGE, sql=f"""
SELECT billing_origin_product AS product,
       CASE WHEN billing_origin_product IN ('SQL', 'ALL_PURPOSE') THEN 'Warehouse / Interactive'
            WHEN billing_origin_product IN ('JOBS', 'DLT', 'INTERACTIVE') THEN 'Jobs / DLT / Serverless'
            ELSE 'Other' END AS bucket,
       CAST(sum(usage_quantity) AS DOUBLE) AS total_usage_quantity
FROM usage WHERE {NET.format(days=30)} GROUP BY ALL""")
def rep_warehouse_vs_jobs_cost_split(t):
    product = F.col("product")
    bucket = (
        F.when(product.isin("SQL", "ALL_PURPOSE"), "Warehouse / Interactive")
        .when(product.isin("JOBS", "DLT", "INTERACTIVE"), "Jobs / DLT / Serverless")
        .otherwise("Other")
    )
    return quantity_by(t.usage, 30, "billing_origin_product").select(
        F.col("billing_origin_product").alias("product"), quantity("total_usage_quantity")
    ).withColumn("bucket", bucket).orderBy(F.desc("total_usage_quantity"))


@query("rep_cost_week_over_week", views=PRICED, sql=f"""
WITH net AS (SELECT CAST(date_trunc('week', usage_date) AS DATE) AS week_start, billing_origin_product AS product,
                    sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE {NET.format(days=56)} GROUP BY ALL), {PRICE_CTE}
SELECT week_start, product, sku_name, usage_unit, CAST(q AS DOUBLE) AS usage_quantity,
       CAST(round(CAST(q AS DECIMAL(18,2)) * coalesce(unit_price, 0), 2) AS DOUBLE) AS estimated_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit)""")
def rep_cost_week_over_week(t):
    weekly = net_usage(t.usage, 56).groupBy(
        F.trunc("usage_date", "week").alias("week_start"), F.col("billing_origin_product").alias("product"),
        "sku_name", "usage_unit",
    ).agg(F.sum("usage_quantity").alias("q"))
    return with_price(weekly, t.list_prices).select(
        "week_start", "product", "sku_name", "usage_unit", quantity(), row_cost()
    ).orderBy(F.desc("week_start"), F.desc("estimated_cost_usd"))


def _since_month_start(usage, months_back: int):
    """Original records from the first day of the month ``months_back`` before the reference day."""
    start = F.expr(f"CAST(add_months(trunc(DATE '{USAGE_AS_OF}', 'month'), -{months_back}) AS TIMESTAMP_NTZ)")
    return usage.where((F.col("record_type") == "ORIGINAL") & (F.col("usage_start_time") >= start))


@query("rep_spend_this_month", views=PRICED, sql=f"""
WITH net AS (SELECT billing_origin_product AS product, sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE record_type = 'ORIGINAL' AND usage_date >= DATE '2001-11-01' GROUP BY ALL), {PRICE_CTE},
priced AS (SELECT * FROM net LEFT JOIN price USING (sku_name, usage_unit))
SELECT 'TOTAL' AS metric, CAST(NULL AS VARCHAR) AS product, {COST} AS estimated_cost_usd FROM priced
UNION ALL
SELECT 'BY_PRODUCT', product, {COST} FROM priced GROUP BY product""")
def rep_spend_this_month(t):
    """Total and per-product rows from one pass (a rollup over the product)."""
    net = _since_month_start(t.usage, 0).groupBy(
        F.col("billing_origin_product").alias("product"), "sku_name", "usage_unit"
    ).agg(F.sum("usage_quantity").alias("q"))
    metric = F.when(F.grouping_id() == 1, "TOTAL").otherwise("BY_PRODUCT").alias("metric")
    return with_price(net, t.list_prices).rollup("product").agg(metric, total_cost()).select(
        "metric", "product", "estimated_cost_usd"
    ).orderBy("metric", F.desc_nulls_last("estimated_cost_usd"))


@query("rep_spend_month_over_month", views=PRICED, sql=f"""
WITH net AS (SELECT CAST(date_trunc('month', usage_date) AS DATE) AS month_start, billing_origin_product AS product,
                    sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE record_type = 'ORIGINAL' AND usage_date >= DATE '2001-09-01' GROUP BY ALL), {PRICE_CTE}
SELECT month_start, product, CAST(sum(q) AS DOUBLE) AS usage_quantity, {COST} AS estimated_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit) GROUP BY month_start, product""")
def rep_spend_month_over_month(t):
    monthly = _since_month_start(t.usage, 2).groupBy(
        F.trunc("usage_date", "month").alias("month_start"), F.col("billing_origin_product").alias("product"),
        "sku_name", "usage_unit",
    ).agg(F.sum("usage_quantity").alias("q"))
    return with_price(monthly, t.list_prices).groupBy("month_start", "product").agg(
        F.sum("q").cast("double").alias("usage_quantity"), total_cost()
    ).orderBy(F.desc("month_start"), F.desc("estimated_cost_usd"))


def _product_sku(t, condition):
    return quantity_by(t.usage.where(condition), 30, "billing_origin_product", "sku_name").select(
        F.col("billing_origin_product").alias("product"), "sku_name", quantity()
    ).orderBy(F.desc("usage_quantity"))


@query("rep_storage_cost", views=USAGE, sql=f"""
SELECT billing_origin_product AS product, sku_name, CAST(sum(usage_quantity) AS DOUBLE) AS usage_quantity
FROM usage WHERE {NET.format(days=30)} AND (billing_origin_product = 'DEFAULT_STORAGE' OR lower(sku_name) LIKE '%storage%')
GROUP BY ALL""")
def rep_storage_cost(t):
    storage = (F.col("billing_origin_product") == "DEFAULT_STORAGE") | F.lower("sku_name").contains("storage")
    return _product_sku(t, storage)


@query("rep_serving_cost", views=USAGE, sql=f"""
SELECT billing_origin_product AS product, sku_name, CAST(sum(usage_quantity) AS DOUBLE) AS usage_quantity
FROM usage WHERE {NET.format(days=30)}
  AND billing_origin_product IN ('MODEL_SERVING', 'AI_GATEWAY', 'AI_FUNCTIONS', 'VECTOR_SEARCH') GROUP BY ALL""")
def rep_serving_cost(t):
    serving = F.col("billing_origin_product").isin("MODEL_SERVING", "AI_GATEWAY", "AI_FUNCTIONS", "VECTOR_SEARCH")
    return _product_sku(t, serving)


@query("rep_cost_per_workspace", views=USAGE, sql=f"""
SELECT workspace_id, billing_origin_product AS product, CAST(sum(usage_quantity) AS DOUBLE) AS usage_quantity
FROM usage WHERE {NET.format(days=30)} GROUP BY ALL ORDER BY usage_quantity DESC, workspace_id, product LIMIT 100""")
def rep_cost_per_workspace(t):
    return quantity_by(t.usage, 30, "workspace_id", "billing_origin_product").select(
        "workspace_id", F.col("billing_origin_product").alias("product"), quantity()
    ).orderBy(F.desc("usage_quantity"), "workspace_id", "product").limit(100)


@query("rep_top_skus", views=PRICED, sql=f"""
WITH net AS (SELECT sku_name, usage_unit, sum(usage_quantity) AS q
             FROM usage WHERE {NET.format(days=30)} GROUP BY ALL), {PRICE_CTE}
SELECT sku_name, usage_unit, CAST(q AS DOUBLE) AS usage_quantity,
       CAST(round(CAST(q AS DECIMAL(18,2)) * coalesce(unit_price, 0), 2) AS DOUBLE) AS estimated_cost_usd
FROM net LEFT JOIN price USING (sku_name, usage_unit)
ORDER BY estimated_cost_usd DESC, sku_name, usage_unit LIMIT 30""")
def rep_top_skus(t):
    return with_price(quantity_by(t.usage, 30, "sku_name", "usage_unit"), t.list_prices).select(
        "sku_name", "usage_unit", quantity(), row_cost()
    ).orderBy(F.desc("estimated_cost_usd"), "sku_name", "usage_unit").limit(30)


CLUSTER_CTE = f"""
net AS (SELECT cluster_id, job_id, sku_name, usage_unit, sum(usage_quantity) AS q
        FROM usage WHERE {NET.format(days=30)} AND cluster_id IS NOT NULL GROUP BY ALL), {PRICE_CTE},
cluster AS (SELECT cluster_id, CAST(sum(q) AS DOUBLE) AS total_usage, {COST} AS estimated_cost_usd,
                   count(DISTINCT job_id) AS distinct_jobs
            FROM net LEFT JOIN price USING (sku_name, usage_unit) GROUP BY cluster_id)"""


def cluster_costs(t):
    """Usage, cost and number of jobs of each cluster, with the cost of one job."""
    net = quantity_by(
        t.usage.where(F.col("cluster_id").isNotNull()), 30, "cluster_id", "job_id", "sku_name", "usage_unit"
    )
    per_cluster = with_price(net, t.list_prices).groupBy("cluster_id").agg(
        F.sum("q").cast("double").alias("total_usage"), total_cost(),
        F.countDistinct("job_id").alias("distinct_jobs"),
    )
    per_job = F.round(F.try_divide("estimated_cost_usd", F.col("distinct_jobs").cast("double")), 2)
    return per_cluster.withColumn("cost_per_job_usd", per_job)


@query("rep_cluster_cost_per_job", views=PRICED, sql=f"""
WITH {CLUSTER_CTE}
SELECT cluster_id, estimated_cost_usd, total_usage, distinct_jobs,
       round(estimated_cost_usd / nullif(distinct_jobs, 0), 2) AS cost_per_job_usd
FROM cluster ORDER BY estimated_cost_usd DESC, cluster_id LIMIT 50""")
def rep_cluster_cost_per_job(t):
    return cluster_costs(t).orderBy(F.desc("estimated_cost_usd"), "cluster_id").limit(50)


@query("rep_clusters_to_optimise", views=PRICED, sql=f"""
WITH {CLUSTER_CTE}
SELECT cluster_id, estimated_cost_usd, distinct_jobs,
       round(estimated_cost_usd / nullif(distinct_jobs, 0), 2) AS cost_per_job_usd
FROM cluster WHERE estimated_cost_usd > 10 AND distinct_jobs < 20
ORDER BY cost_per_job_usd DESC NULLS LAST, cluster_id LIMIT 30""")
def rep_clusters_to_optimise(t):
    return cluster_costs(t).where("estimated_cost_usd > 10 AND distinct_jobs < 20").drop("total_usage").orderBy(
        F.desc_nulls_last("cost_per_job_usd"), "cluster_id").limit(30)


@query("rep_sku_month", views=USAGE, sql="""
SELECT sku_name, CAST(month(usage_date) AS INTEGER) AS month_usage, CAST(year(usage_date) AS INTEGER) AS year_usage,
       CAST(round_even(sum(usage_quantity), 1) AS DOUBLE) AS units
FROM usage GROUP BY ALL""")
def rep_sku_month(t):
    return t.usage.groupBy(
        "sku_name", F.month("usage_date").alias("month_usage"), F.year("usage_date").alias("year_usage")
    ).agg(F.bround(F.sum("usage_quantity"), 1).cast("double").alias("units"))


@query("rep_daily_consumption", views=USAGE, sql="""
SELECT usage_date, sku_name, CAST(round_even(sum(usage_quantity), 1) AS DOUBLE) AS units FROM usage GROUP BY ALL""")
def rep_daily_consumption(t):
    return t.usage.groupBy("usage_date", "sku_name").agg(
        F.bround(F.sum("usage_quantity"), 1).cast("double").alias("units")).orderBy("usage_date", "sku_name")


@query("rep_cost_by_owner_tag", views=USAGE, sql="""
SELECT tag_team AS owner, CAST(round_even(sum(usage_quantity), 1) AS DOUBLE) AS units
FROM usage WHERE tag_team IS NOT NULL GROUP BY ALL""")
def rep_cost_by_owner_tag(t):
    owner = tag_map(Owner="tag_team")["Owner"]
    return t.usage.select(owner.alias("owner"), "usage_quantity").where(F.col("owner").isNotNull()).groupBy(
        "owner").agg(F.bround(F.sum("usage_quantity"), 1).cast("double").alias("units")).orderBy(F.desc("units"))


# The sku families of the five spend reports are parameters: which skus count as
# interactive, job, inference, table-flow or query compute differs per account.
SKU_FAMILIES = {
    "rep_interactive_cost": ("Brand#1", "Brand#2", "Brand#3", "Brand#4"),
    "rep_job_cost": ("Brand#5", "Brand#6", "Brand#7"),
    "rep_inference_cost": ("Brand#8", "Brand#9", "Brand#10", "Brand#11", "Brand#12"),
    "rep_pipeline_cost": ("Brand#13", "Brand#14", "Brand#15", "Brand#16", "Brand#17"),
    "rep_sql_cost": ("Brand#18", "Brand#19", "Brand#20", "Brand#21"),
}


def sku_family_by_month(usage: DataFrame, skus: tuple[str, ...]) -> DataFrame:
    """Monthly quantity of the named skus."""
    return usage.where(F.col("sku_name").isin(*skus)).groupBy(
        "sku_name", F.month("usage_date").alias("nbr_month")
    ).agg(F.sum("usage_quantity").cast("double").alias("units"))


def _register_family(key: str, skus: tuple[str, ...]) -> None:
    names = ", ".join(f"'{s}'" for s in skus)
    query(key, views=USAGE, sql=f"""
SELECT CAST(month(usage_date) AS INTEGER) AS nbr_month, CAST(sum(usage_quantity) AS DOUBLE) AS units, sku_name
FROM usage WHERE sku_name IN ({names}) GROUP BY ALL""")(lambda t: sku_family_by_month(t.usage, skus))


for _key, _skus in SKU_FAMILIES.items():
    _register_family(_key, _skus)
