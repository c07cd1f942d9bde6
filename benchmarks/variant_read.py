"""Read the same three paths from JSON text, from a plain VARIANT, from one that Parquet stores shredded, and from typed columns.

Spark 4.1 shreds a VARIANT when it writes Parquet; the plain one is written with that turned off.

python benchmarks/variant_read.py [rows] ; writes to a new folder under /tmp.
"""

from __future__ import annotations

import statistics
import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/benchmarks/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from lakejobs.functions.semi import shred  # noqa: E402
from lakejobs.session import build_session  # noqa: E402
from lakejobs.sources.generators import orders  # noqa: E402


def main(rows: int) -> None:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("8", "variant")
    doc = F.to_json(F.struct(
        F.struct(F.col("customer_id").alias("id"), F.col("region").alias("region")).alias("user"),
        F.struct("product_id", "quantity", "amount", "discount", "shipping", "status", "payment", "channel").alias("order"), "ordered_at"))
    orders(spark, rows).select("order_id", doc.alias("body")).write.parquet(f"{root}/json")
    text = spark.read.parquet(f"{root}/json")
    for name, on in (("variant", "false"), ("native", "true")):
        spark.conf.set("spark.sql.variant.writeShredding.enabled", on)
        spark.conf.set("spark.sql.variant.inferShreddingSchema", on)
        start = time.perf_counter()
        text.select("order_id", F.parse_json("body").alias("v")).write.parquet(f"{root}/{name}")
        print(f"write {name} {time.perf_counter() - start:.1f} s")
    variant, native = spark.read.parquet(f"{root}/variant"), spark.read.parquet(f"{root}/native")
    paths = {"region": ("$.user.region", "string"), "amount": ("$.order.amount", "double"), "status": ("$.order.status", "string")}
    start = time.perf_counter()
    shred(text.select("order_id", F.parse_json("body").alias("v")), "v", paths).write.parquet(f"{root}/shredded")
    print(f"write shredded {time.perf_counter() - start:.1f} s")
    shredded = spark.read.parquet(f"{root}/shredded")

    def report(df):
        return df.where("status = 'completed'").groupBy("region").agg(F.sum("amount"))

    forms = {
        "json text": text.select(*[F.get_json_object("body", p).cast(k).alias(n) for n, (p, k) in paths.items()]),
        "plain variant": variant.select(*[F.variant_get("v", p, k).alias(n) for n, (p, k) in paths.items()]),
        "natively shredded": native.select(*[F.variant_get("v", p, k).alias(n) for n, (p, k) in paths.items()]),
        "typed columns": shredded.select(*paths),
    }
    for name, df in forms.items():
        times = []
        for _ in range(4):
            start = time.perf_counter()
            report(df).collect()
            times.append(time.perf_counter() - start)
        print(f"read {name}: {statistics.median(times[1:]):.2f} s")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000)
