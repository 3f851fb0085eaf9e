"""Summarise the physical plan of every registered query as it would be planned on large data.

The broadcast threshold is lowered to 20 KB, so only the fixed-size nation and
region tables and tiny aggregates qualify, and AQE is off to show the static
plan.  Customer, part, orders and lineitem are then planned as large tables,
which is the 100 TB situation.  Writes a markdown report to stdout.

Usage: python tools/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    real = [ln for ln in lines if "Exchange " in ln and "ReusedExchange" not in ln and "BroadcastExchange" not in ln]
    exchanges = [m.group(1) for ln in real
                 for m in [re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", ln)]
                 if m]
    reused = sum(1 for ln in lines if "ReusedExchange" in ln)
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            table = re.search(r"/(\w+)\.parquet\]", line)
            schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
            scans.append((table.group(1) if table else "?", schema.group(1) if schema else ""))
    return {
        "hash": exchanges.count("hashpartitioning"),
        "range": exchanges.count("rangepartitioning"),
        "single": exchanges.count("SinglePartition"),
        "reused": reused,
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "partial": plan.count("partial_"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "lineitem_cols": sorted({c.split(":")[0] for t, cols in scans if t == "lineitem" for c in cols.split(",") if c}),
        "tables": sorted({t for t, _ in scans}),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    only = argv[2:]
    from salesnet.session import get_session
    from salesnet.plans.registry import all_queries

    spark = get_session("local[8]", shuffle_partitions=200, extra={
        "spark.sql.autoBroadcastJoinThreshold": "20000", "spark.sql.adaptive.enabled": "false"})
    jvm = spark.sparkContext._jvm
    print("| query | hash shuffles | range | single-partition | reused exchanges | sort-merge joins "
          "| broadcast joins | partial aggs | windows | tables read | lineitem columns |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in all_queries().items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        s = summarise(plan)
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['reused']} | {s['smj']} | {s['bhj']} | {s['partial']} "
              f"| {s['windows']} | {', '.join(s['tables'])} | {', '.join(s['lineitem_cols']) or '-'} |")
        if only:
            print("\n```\n" + plan + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
