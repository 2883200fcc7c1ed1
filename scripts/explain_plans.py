"""Summarise the physical plans of the headline queries at their at-scale shape
(automatic broadcast and AQE off, so joins show as they would on large data)
into PLANS.md: exchanges, aggregate kinds, joins, pushed scan filters.

usage: python scripts/explain_plans.py [sf_dir]
"""
from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from balances.session import build_session  # noqa: E402
from balances.plans.queries import queries  # noqa: E402
import bench  # noqa: E402


def summarise(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    return {
        "exchanges": nodes.count("Exchange"),
        "hash_agg": nodes.count("HashAggregate"),
        "sort_agg": nodes.count("SortAggregate"),
        "smj": nodes.count("SortMergeJoin"),
        "bhj": nodes.count("BroadcastHashJoin"),
        "windows": nodes.count("Window"),
        "scans_with_pushed_filters": sum(1 for p in pushed if p.strip()),
        "scans": nodes.count("Scan"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs = queries()
    rows = []
    for name in bench.HEADLINE:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf).explain("formatted")
        rows.append((name, summarise(buf.getvalue())))
    cols = list(rows[0][1])
    out = ["# Physical plan summary (headline queries)", "",
           "Generated by `scripts/explain_plans.py` with automatic broadcast and AQE off, i.e. the",
           "plan shape on large inputs. Reads of materialised layers (checkpoints) appear as scans",
           "of the layer; explicit broadcasts are only the bounded tables listed in README.", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
