"""Benchmark: the headline operators at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}. Each query is
run once to warm up, then ``$BENCH_REPEAT`` times (default 3); the median is reported.
Queries run to completion through the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableferry import fixtures  # noqa: E402
from tableferry.operators import profile, quality, reconcile  # noqa: E402
from tableferry.plans import jobs  # noqa: E402
from tableferry.queries import _target_types  # noqa: E402
from tableferry.session import build_session, new_run_dir  # noqa: E402
from tableferry.sources import paging  # noqa: E402
from tableferry.sources.tables import TPCH_TABLES, read_database  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", app_name="tableferry-bench", shuffle_partitions=int(cpus))

    def transfer_all():
        db = read_database(spark, sf_dir, TPCH_TABLES)
        run = jobs.transfer_all(spark, db, new_run_dir(spark, "bench-transfer"))
        return jobs.transfer_report(run).collect()

    def verify_tables():
        src = read_database(spark, sf_dir, TPCH_TABLES)
        run_noop(reconcile.verify_tables(spark, src, fixtures.damaged_target(src), [(t, t) for t in TPCH_TABLES]))

    def extreme_values():
        li = read_database(spark, sf_dir, ["lineitem"]).table("lineitem")
        cols = profile.numeric_columns(li, ("int", "bigint", "decimal", "numeric", "float", "real", "money"))
        run_noop(profile.extreme_values(li, "lineitem", cols))

    def scan_paged():
        o = read_database(spark, sf_dir, ["orders"]).table("orders")
        run_noop(paging.scan_paged(o, ["o_orderkey"]))

    def content_diff():
        src = read_database(spark, sf_dir, ["orders"])
        tgt = fixtures.damaged_target(src)
        run_noop(reconcile.content_diff(src.table("orders"), tgt.table("orders"), ["o_orderkey"]))

    def quarantine():
        docs = read_database(spark, sf_dir, ["documents"]).table("documents")
        types = _target_types(spark, sf_dir, "documents")
        run_noop(quality.quarantine_good(docs, types))
        run_noop(quality.quarantine_bad(docs, types))

    benches = {
        "transfer_all": transfer_all,
        "verify_tables": verify_tables,
        "extreme_values": extreme_values,
        "scan_paged": scan_paged,
        "content_diff": content_diff,
        "quarantine": quarantine,
    }
    if os.environ.get("BENCH_ONLY"):
        benches = {k: v for k, v in benches.items() if k in os.environ["BENCH_ONLY"].split(",")}
    results = {}
    for name, fn in benches.items():
        fn()  # warm-up
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)

    rows = sum(
        read_database(spark, sf_dir, [t]).table(t).count() for t in TPCH_TABLES
    )
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": sf,
                "transfer_rows_per_sec": round(rows / results["transfer_all"], 1) if "transfer_all" in results else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
