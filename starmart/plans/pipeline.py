"""The whole batch: CSV extracts -> checked, published star (entry A).

Stages (each a plain function; Spark shuffles are the only node boundary):

1. contract  - every source file checked; an error stops the run
2. ingest    - CSV -> typed Parquet in the ``raw`` layer, with ingest metrics
3. models    - staging and intermediate stay lazy; the mart fact and
               dimension are written once (five metrics read them)
4. metrics   - five metric tables written to the ``metrics`` layer
5. checks    - declared tests on staging, intermediate and marts
6. gate      - any failing test stops publication (unless skipped)
7. promote   - marts and metrics copied to the ``serving`` layer, flags as ints

Re-running replaces every table, so a re-run gives the same result.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.checks import CheckSpec, gate, run_checks
from starmart.plans import models as M
from starmart.plans.serving import promote
from starmart.session import run_concurrently
from starmart.sources.contract import contract_all, csv_contract, enforce, rows_report
from starmart.sources.ingest import ingest_all
from starmart.sources.layers import layer_path, read_layer, write_layer
from starmart.specs import HEALTH_FILES, HEALTH_SPECS, MODEL_TESTS

log = logging.getLogger("starmart.pipeline")

STAGES = ("contract", "ingest", "models", "checks", "promote")
STAGED_NAMES = {"dim_student": "stg_student", "dim_health": "stg_health",
                "dim_lifestyle": "stg_lifestyle", "dim_activity": "stg_activity",
                "dim_sleep": "stg_sleep", "dim_date": "stg_date",
                "fact_health_analytics": "stg_fact"}


@dataclass
class RunResult:
    timings: dict = field(default_factory=dict)
    ingest: dict = field(default_factory=dict)
    check_report: DataFrame | None = None
    row_report: DataFrame | None = None
    published: list = field(default_factory=list)


def _raw(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    return {n: read_layer(spark, out_root, "raw", n, HEALTH_SPECS[n].schema) for n in HEALTH_SPECS}


def build_models(raw: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """All model DataFrames (lazy) keyed by model name."""
    stg = {name: M.STAGERS[name](df) for name, df in raw.items()}
    features = M.student_features(stg["dim_student"], as_of=as_of)
    enriched = M.fact_enriched(stg, features)
    models = {STAGED_NAMES[k]: v for k, v in stg.items()}
    models.update({
        "int_student_features": features,
        "int_fact_enriched": enriched,
        "fact_health_transformed": M.mart_fact(enriched),
        "dim_student_transformed": M.mart_dim(features),
    })
    return models


def declared_checks() -> dict[str, CheckSpec]:
    return {m: CheckSpec(unique=u, not_null=n) for m, (u, n) in MODEL_TESTS.items()}


def run(spark: SparkSession, source_dir: str, out_root: str, *, as_of=None,
        skip_checks: bool = False, stages=STAGES,
        partition_fact_by: tuple = (), parallel: int = 4) -> RunResult:
    """Run the selected stages in order; the first failure raises.

    ``partition_fact_by`` (e.g. ``("year", "month")``) writes the mart fact
    in Hive-style folders so date filters prune whole partitions.
    ``parallel`` independent tables (ingest, metrics, promotions) are written
    as concurrent Spark jobs, like the reference's four model threads.
    """
    res = RunResult()

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        res.timings[name] = round(time.perf_counter() - t0, 3)
        log.info("stage %s done in %.1fs", name, res.timings[name])
        return out

    if "contract" in stages:
        # Metadata checks only when ingest follows: its write pass counts the rows.
        count_rows = "ingest" not in stages
        timed("contract", lambda: enforce(contract_all({
            n: csv_contract(spark, f"{source_dir.rstrip('/')}/{HEALTH_FILES[n]}", s,
                            count_rows=count_rows)
            for n, s in HEALTH_SPECS.items()})))
    if "ingest" in stages:
        res.ingest = timed("ingest", lambda: ingest_all(
            spark, source_dir, HEALTH_SPECS, HEALTH_FILES, f"{out_root}/raw",
            audit_path=f"{out_root}/audit/ingest_log", quarantine_root=f"{out_root}/quarantine",
            max_parallel=parallel))
        res.row_report = rows_report(spark, {n: r.rows for n, r in res.ingest.items()},
                                     HEALTH_SPECS)
        enforce(res.row_report)
    models = build_models(_raw(spark, out_root), as_of) if stages != ("contract",) else {}
    if "models" in stages:
        def materialise():
            write_layer(models["fact_health_transformed"], out_root, "marts",
                        "fact_health_transformed", partition_by=partition_fact_by)
            write_layer(models["dim_student_transformed"], out_root, "marts",
                        "dim_student_transformed")
            fact = read_layer(spark, out_root, "marts", "fact_health_transformed")
            run_concurrently([(write_layer, fn(fact), out_root, "metrics", name)
                           for name, fn in M.METRICS.items()], parallel)
        timed("models", materialise)
    if "checks" in stages:
        fact = read_layer(spark, out_root, "marts", "fact_health_transformed")
        tables = dict(models)
        tables["fact_health_transformed"] = fact
        tables["dim_student_transformed"] = read_layer(spark, out_root, "marts",
                                                       "dim_student_transformed")
        tables["mrt_health_distribution"] = read_layer(spark, out_root, "metrics",
                                                       "mrt_health_distribution")
        # The marts are row-for-row projections of the intermediate models and
        # carry every tested column, so the intermediate tests read the written
        # marts instead of recomputing the star join.
        tables["int_fact_enriched"] = tables["fact_health_transformed"]
        tables["int_student_features"] = tables["dim_student_transformed"]
        report = timed("checks", lambda: run_checks(tables, declared_checks()))
        res.check_report = report
        if not skip_checks:
            gate(report)
    if "promote" in stages:
        def promote_one(df, path, batchsize):
            promote(df, path=path, batchsize=batchsize)

        def publish():
            jobs = []
            for layer, names in (("marts", ("fact_health_transformed",
                                            "dim_student_transformed")),
                                 ("metrics", tuple(M.METRICS))):
                for name in names:
                    jobs.append((promote_one, read_layer(spark, out_root, layer, name),
                                 layer_path(out_root, "serving", name),
                                 2000 if layer == "marts" else 1000))
                    res.published.append(name)
            run_concurrently(jobs, parallel)
        timed("promote", publish)
    return res
