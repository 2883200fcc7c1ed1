"""Benchmark: run the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is forced to full evaluation with the ``noop`` sink (no collect to
the driver). One untimed warm-up query runs first so JVM start-up and code
generation are not charged to the first timed query.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "global_cut", "balance_snapshot", "monthly_panel", "liquid_cv", "customer_features",
    "priority_levels", "segment_rates", "woe_iv_numeric", "mann_whitney_u", "chi2_cramer",
    "star_fact", "backtest", "score_fact", "sizing", "fairness_fact", "targeting_curve",
    "contact_list", "evidence_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    os.environ.setdefault("BALANCES_DRIVER_MEMORY", os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
    from balances.session import build_session
    from balances.plans.queries import queries

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8))
    qs = queries()
    names = [n for n in HEADLINE if n in qs]
    only = os.environ.get("BENCH_QUERIES")
    if only:
        names = [n for n in only.split(",") if n in qs]

    # warm-up (untimed): JVM JIT, parquet footer cache, codegen
    qs["global_cut"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
