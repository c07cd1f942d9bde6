"""Row generators for load tests: every value is a function of the row id and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(salt: int, seed: int = 42) -> Column:
    """Number in [0, 1) from the id; stable across runs, partitions and retries."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(salt), F.lit(seed)), F.lit(1_000_000_007)) / 1_000_000_007.0


def pick(draw: Column, shares: Sequence[tuple[str, float]]) -> Column:
    """Category by one draw against cumulative shares; the last category takes the rest."""
    bound, choice = 0.0, None
    for name, share in shares[:-1]:
        bound += share
        choice = F.when(draw < bound, name) if choice is None else choice.when(draw < bound, name)
    last = F.lit(shares[-1][0])
    return last if choice is None else choice.otherwise(last)


def customers(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    return spark.range(rows).select(
        "id", F.concat(F.lit("Customer_"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("name"),
        F.concat(F.lit("customer"), F.col("id").cast("string"), F.lit("@example.com")).alias("email"),
        F.element_at(F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")), (F.col("id") % 3 + 1).cast("int")).alias("tier"),
        F.round(uniform(1, seed) * 10_000, 2).alias("balance"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(uniform(2, seed) * 1500).cast("int")).alias("signup_date"),
        F.timestamp_seconds(F.lit(1_577_836_800) + F.floor(uniform(3, seed) * 126_230_400)).alias("last_seen"))


def orders(spark: SparkSession, rows: int, first_id: int = 0, seed: int = 42) -> DataFrame:
    """16-column orders. New orders of a later batch start at an id past the earlier ones."""
    money = "decimal(10,2)"
    quantity = F.floor(uniform(4, seed) * 20).cast("int") + 1
    price = F.round(uniform(5, seed) * 500 + 1, 2).cast(money)
    ordered = F.timestamp_seconds(F.lit(1_672_531_200) + F.floor(uniform(6, seed) * 63_072_000))
    return spark.range(first_id, first_id + rows).select(
        F.col("id").alias("order_id"), F.floor(uniform(7, seed) * 1_000_000).cast("long").alias("customer_id"),
        F.floor(uniform(8, seed) * 50_000).cast("long").alias("product_id"), quantity.alias("quantity"),
        price.alias("unit_price"), (price * quantity).cast("decimal(12,2)").alias("amount"),
        F.round(uniform(9, seed) * 0.3, 2).cast("decimal(3,2)").alias("discount"),
        F.round(uniform(10, seed) * 40, 2).cast("decimal(8,2)").alias("shipping"),
        pick(uniform(11, seed), [("completed", 0.6), ("shipped", 0.2), ("pending", 0.15), ("cancelled", 0.05)]).alias("status"),
        pick(uniform(12, seed), [("card", 0.5), ("transfer", 0.3), ("wallet", 0.2)]).alias("payment"),
        pick(uniform(13, seed), [("north", 0.3), ("south", 0.3), ("east", 0.2), ("west", 0.2)]).alias("region"),
        pick(uniform(14, seed), [("web", 0.55), ("mobile", 0.35), ("store", 0.1)]).alias("channel"),
        pick(uniform(15, seed), [("normal", 0.8), ("high", 0.2)]).alias("priority"),
        ordered.alias("ordered_at"), F.timestamp_add("DAY", F.lit(3), ordered).alias("due_at"),
        F.current_timestamp().alias("updated_at"))
