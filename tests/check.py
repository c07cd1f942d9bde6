"""Command line check: python tests/check.py [prefix ...] compares queries at sf0.01."""

from __future__ import annotations

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as entry_module  # noqa: E402
from lakejobs.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(prefixes: list[str]) -> int:
    path = "/root/testdata/sf0.01"
    spark = build_session()
    con = connect(path)
    oracles = entry_module.oracle_sql()
    bad = 0
    for key, build in entry_module.queries().items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, path)
            if key in oracles:
                count, reason = compare(df, con, oracles[key])
            else:
                count, reason = len(df.collect()), None
        except Exception as error:  # noqa: BLE001 - report and go on
            count, reason = -1, f"{type(error).__name__}: {str(error)[:700]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        took = time.time() - start
        if reason:
            bad += 1
            print(f"FAIL {key} {took:.1f}s {reason}", flush=True)
        elif count == 0 or took > 4 or "-a" in sys.argv:
            print(f"ok   {key} rows={count} {took:.1f}s {'' if key in oracles else 'no-oracle'}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main([a for a in sys.argv[1:] if not a.startswith("-")]) else 0)
