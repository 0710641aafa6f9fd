"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line::

    {"metric": "total_query_seconds", "value": N, "unit": "sec",
     "queries": {"q": sec, ...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected on the driver).  One warm-up run of the first query pays
for JVM start and class loading; each query is then timed once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans.queries import QUERIES  # noqa: E402
from starmart.session import build_session, remove_scratch  # noqa: E402

HEADLINE = (
    "mart_fact", "metric_distribution", "metric_band_by_group", "metric_adequacy",
    "metric_weekly", "metric_risk", "class_balance", "list_records_page", "get_record",
    "check_report", "fk_failures", "scd_as_of", "trend_direction", "user_trajectory",
    # these write
    "csv_roundtrip_coerce", "ingest_tables", "partitioned_stage", "stream_weekly", "scd_history",
    "published_counts",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or \
        [n for n in HEADLINE if n in QUERIES] + sorted(
            n for n in QUERIES if n not in HEADLINE and os.environ.get("BENCH_ALL") == "1")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    run(QUERIES[names[0]](spark, sf_dir))  # warm-up
    timings, errors = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            run(QUERIES[name](spark, sf_dir))
        except Exception as e:  # report the failure, keep timing the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        timings[name] = round(time.perf_counter() - t0, 3)
        remove_scratch(spark)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
