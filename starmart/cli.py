"""Command line: run the pipeline or one read query.

    python -m starmart.cli run --source DIR --out ROOT [--stage contract|ingest|models|checks|promote]
                               [--skip-tests] [--as-of YYYY-MM-DD] [--master local[8]]
    python -m starmart.cli query NAME --sf DIR [--show 20]
    python -m starmart.cli tables --out ROOT

``--stage`` runs the pipeline up to and including that stage (the stages
before it are needed by it), like the reference's per-stage runner.
"""

from __future__ import annotations

import argparse
import json
import sys

from starmart.plans import pipeline


def _session(master: str | None):
    from starmart.session import build_session
    return build_session(master=master or "local[*]")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="starmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run the batch pipeline")
    r.add_argument("--source", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--stage", choices=pipeline.STAGES)
    r.add_argument("--skip-tests", action="store_true")
    r.add_argument("--as-of")
    r.add_argument("--master")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--master")
    t = sub.add_parser("tables", help="row counts of every layer table")
    t.add_argument("--out", required=True)
    t.add_argument("--master")
    a = p.parse_args(argv)

    spark = _session(a.master)
    try:
        if a.cmd == "run":
            stages = pipeline.STAGES
            if a.stage:
                stages = stages[:stages.index(a.stage) + 1]
            res = pipeline.run(spark, a.source, a.out, as_of=a.as_of,
                               skip_checks=a.skip_tests, stages=stages)
            print(json.dumps({"timings": res.timings, "published": res.published,
                              "rows": {k: v.rows for k, v in res.ingest.items()}}))
        elif a.cmd == "query":
            from starmart.plans.queries import QUERIES
            QUERIES[a.name](spark, a.sf).show(a.show, truncate=False)
        else:
            from starmart.sources.layers import layer_summary
            from starmart.plans.models import METRICS
            names = {"raw": tuple(pipeline.HEALTH_SPECS),
                     "marts": ("fact_health_transformed", "dim_student_transformed"),
                     "metrics": tuple(METRICS), "serving": ("fact_health_transformed",
                                                            "dim_student_transformed",
                                                            *METRICS)}
            for layer, tables in names.items():
                print(f"[{layer}]")
                layer_summary(spark, a.out, layer, tables).show(50, truncate=False)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
