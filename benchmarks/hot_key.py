"""Running totals and as-of join with a third of all rows on one key: one window per key against slices.

python benchmarks/hot_key.py [rows]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/benchmarks/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from lakejobs.operators.ordered import Slices, asof_join, plan_slices, running_totals  # noqa: E402
from lakejobs.session import build_session  # noqa: E402


def main(rows: int) -> None:
    spark = build_session("8", "hot", **{"spark.sql.shuffle.partitions": "64"})
    key = F.when(F.col("id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)))
    at = F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30_000_000)))
    events = spark.range(rows).select("id", key.alias("k"), at.alias("ts"), (F.col("id") % 97).alias("v"))
    labels = events.where("id % 10 = 1 OR id % 30 = 0")
    facts = events.where("id % 10 = 4 OR id % 30 = 3").select("k", F.col("ts").alias("fts"), F.col("v").alias("fv"), F.col("id").alias("fid"))
    start = time.perf_counter()
    cut = plan_slices(events, "ts", rows // 40)
    print(f"borders: {time.perf_counter() - start:.1f} s, {len(cut.borders) + 1} slices")
    for name, slices in (("one window per key", Slices()), ("slices", cut)):
        totals = running_totals(events, ["k"], ["ts", "id"], {"n": F.lit(1), "total": F.col("v")}, slices)
        joined = asof_join(labels, facts, ["k"], "ts", "fts", ["fv"], tie_break=["fid"], slices=slices)
        for what, df in (("running totals", totals.agg(F.count("*"), F.sum("n"), F.sum("total"))), ("as-of join", joined.agg(F.count("*"), F.sum("fv")))):
            start = time.perf_counter()
            found = tuple(df.first())
            print(f"{what}, {name}: {time.perf_counter() - start:.1f} s, check {found}")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)
