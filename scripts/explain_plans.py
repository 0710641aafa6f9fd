"""Summarise physical plans of registered queries as they would run at scale.

Size-based auto-broadcast is switched off, so only broadcasts proven by a
row-count check remain (what a cluster sees when dimensions are large).
Prints, per query: join strategies, exchanges (shuffles), scans with their
pushed filters and read columns.  With ``--runtime`` the session keeps its
normal settings (AQE on), each query is executed and the *final* adaptive
plan is summarised (what AQE made of it at the test size).

Usage: python scripts/explain_plans.py [--runtime] [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.plans.queries import QUERIES  # noqa: E402
from starmart.session import build_session  # noqa: E402

DEFAULT = ("metric_distribution", "metric_risk", "list_records_page", "check_report",
           "scd_as_of", "trend_direction", "weekly_active")


def summarise(plan: str) -> dict:
    joins = re.findall(r"^\(\d+\) (\w*Join)\b", plan, re.M)
    exchanges = re.findall(r"Arguments: (hashpartitioning\([^)]*\)[^,\n]*|rangepartitioning"
                           r"\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", plan)
    scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/([\w.]+)\]\n"
                       r"(?:PushedFilters: (\[[^\n]*\])\n)?ReadSchema: struct<([^>]*)>", plan)
    return {"joins": joins, "exchanges": exchanges, "scans": scans}


def summarise_final(plan: str) -> dict:
    """Same summary from the tree string of a final adaptive plan."""
    joins = re.findall(r"(\w+Join) \[", plan)
    exchanges = re.findall(r"\bExchange (hashpartitioning\([^)]*\)[^,\n]*|rangepartitioning"
                           r"\([^)]*\)|SinglePartition)", plan)
    scans = re.findall(r"/([\w.]+)\], PartitionFilters: \[[^\]]*\], "
                       r"(?:PushedFilters: (\[[^\n]*?\]), )?ReadSchema: struct<([^>]*)>", plan)
    return {"joins": joins, "exchanges": exchanges, "scans": scans}


def main(argv):
    runtime = "--runtime" in argv
    argv = [a for a in argv if a != "--runtime"]
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or DEFAULT
    spark = build_session(extra={"spark.sql.maxMetadataStringLength": "100000"}) if runtime \
        else build_session(
        extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    for name in names:
        df = QUERIES[name](spark, sf)
        if runtime:
            df.collect()  # the adaptive plan is final once the query has run
        plan = df._jdf.queryExecution().executedPlan().toString()
        if runtime:
            plan = df._jdf.queryExecution().executedPlan().executedPlan().toString()
            s = summarise_final(plan)
        else:
            formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(),
                                                                 "formatted")
            s = summarise(formatted)
        print(f"== {name}")
        print("   joins:", ", ".join(s["joins"]) or "-")
        print(f"   exchanges ({len(s['exchanges'])}):")
        for e in s["exchanges"]:
            print("     ", e[:110])
        for table, pushed, cols in s["scans"]:
            ncols = len(cols.split(","))
            print(f"   scan {table}: {ncols} cols, pushed {pushed or '[]'}"[:160])
        print("   whole-stage codegen stages:", plan.count("*("))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
