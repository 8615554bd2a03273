"""Summarise the executed plan of every registered query (run after the query, so the
adaptive plan is final). Writes a markdown table to stdout.

usage: python plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "WindowGroupLimit", "Generate",
       "TakeOrderedAndProject"]


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]   # the adaptive plan string also prints the initial plan
    c = collections.Counter()
    for op in OPS:
        c[op] = len(re.findall(rf"\b{op}\b", plan))
    c["shuffle"] = len(re.findall(r"Exchange (hashpartitioning|RoundRobin|rangepartitioning|SinglePartition)", plan))
    c["broadcast"] = plan.count("BroadcastExchange")
    c["reused"] = plan.count("Reused")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[file:[^\]]*/(\w+)\.parquet\]", plan)
    return {"ops": c, "scans": sorted({f"{t}({len(cols.split(','))})" for cols, t in scans})}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from fieldstack import get_session
    from fieldstack.plans.catalog import QUERIES
    spark = get_session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed plans ({os.path.basename(sf)}, local[8], AQE final plans)\n")
    print("Per query: shuffles (hash/round-robin/range exchanges), broadcasts, joins, aggregates, windows, and the "
          "parquet scans with the number of columns read. Generated by `plan_report.py`.\n")
    print("| query | shuffles | bcast | joins | aggregates | windows | scans (cols read) |")
    print("|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        if name.startswith("stream_"):
            continue
        df = QUERIES[name](spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        o = s["ops"]
        joins = ", ".join(f"{k} {o[k]}" for k in OPS[:5] if o[k])
        aggs = ", ".join(f"{k} {o[k]}" for k in ["HashAggregate", "ObjectHashAggregate", "SortAggregate"] if o[k])
        wins = ", ".join(f"{k} {o[k]}" for k in ["Window", "WindowGroupLimit", "TakeOrderedAndProject"] if o[k])
        print(f"| {name} | {o['shuffle']} | {o['broadcast']} | {joins or '-'} | {aggs or '-'} | {wins or '-'} | "
              f"{', '.join(s['scans'])} |")


if __name__ == "__main__":
    main()
