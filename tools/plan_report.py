"""Summarise the physical plan of every registered query (from ``explain()``).

    python tools/plan_report.py [sf_dir] > PLANS.md

Round-trip queries run their fixture writes first (they build the data they
read back); the summary is of the returned DataFrame's plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(text: str) -> dict:
    b = text.count("BroadcastExchange")
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    return {
        "shuffles": text.count("Exchange ") - b,
        "broadcasts": b,
        "window": "Window" in text,
        "single_partition": "SinglePartition" in text,
        "sort_aggregate": "SortAggregate" in text,
        "scans": len(re.findall(r"(FileScan|Scan JDBCRelation|Scan parquet)", text)),
        "pushed": sum(1 for p in pushed if p.strip()),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tributary.plans import roundtrips  # noqa: F401  (registers the round-trip queries)
    from tributary.plans.registry import QUERIES
    from tributary.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan summary of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}`.  `shuffles` counts hash/range/single-partition")
    print("exchanges, `broadcasts` broadcast exchanges; `SinglePartition` exchanges here are only the final")
    print("step of global aggregates (one partial row per task), never a window over all rows.\n")
    print("| query | shuffles | broadcasts | window | sort agg | scans | scans with pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        s = summarize(explain(fn(spark, sf)))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {'yes' if s['window'] else '-'} | "
              f"{'yes' if s['sort_aggregate'] else '-'} | {s['scans']} | {s['pushed']} |")


if __name__ == "__main__":
    main(sys.argv)
