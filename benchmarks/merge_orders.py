"""Merge 200,000 updates and 100,000 new orders into a generated 16-column table, two plans.

python benchmarks/merge_orders.py [target rows] ; writes to a new folder under /tmp.
"""

from __future__ import annotations

import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/benchmarks/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from lakejobs.operators.merge import Matched, MergePlan, NotMatched, merge  # noqa: E402
from lakejobs.session import build_session  # noqa: E402
from lakejobs.sources.generators import orders  # noqa: E402

CHANGED = ("quantity", "amount", "discount", "shipping", "status", "payment", "priority", "updated_at")


def main(rows: int) -> None:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    # The source is a file of known size, so a broadcast up to 128 MB is a checked choice.
    spark = build_session("8", "merge", **{"spark.sql.autoBroadcastJoinThreshold": "128m"})
    orders(spark, rows).write.parquet(f"{root}/target")
    step = max(1, rows // 200_000)
    updates = orders(spark, rows, seed=7).where(F.col("order_id") % step == 0)
    updates.unionByName(orders(spark, 100_000, first_id=rows)).coalesce(2).write.parquet(f"{root}/source")
    target, source = spark.read.parquet(f"{root}/target"), spark.read.parquet(f"{root}/source")
    plan = MergePlan((Matched({c: F.col(f"s.{c}") for c in CHANGED}),), (NotMatched(),))
    for name, small in (("full outer join", False), ("small source", True)):
        start = time.perf_counter()
        merge(target, source, ["order_id"], plan, small).write.parquet(f"{root}/{name.replace(' ', '_')}")
        print(f"{name}: {time.perf_counter() - start:.1f} s, rows {spark.read.parquet(root + '/' + name.replace(' ', '_')).count()}")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)
