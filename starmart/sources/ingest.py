"""Ingest CSV extracts into typed Parquet (S-03 ... S-08).

One pass per table: the CSV is parsed, coerced and written; row count, NULL
counts of required columns and cast failures are gathered on the same pass
with an ``Observation``.  The duplicate count (a distinct count) runs on the
written Parquet, reading one column.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.profile import duplicate_count
from starmart.sources.csv import coerce, read_csv_raw, split_quarantine
from starmart.sources.csv import cast_failure_metrics
from starmart.sources.layers import read_table, replace_parquet
from starmart.session import run_concurrently
from starmart.specs import TableSpec


@dataclass
class IngestResult:
    table: str
    path: str
    rows: int
    parity_ok: bool | None
    null_counts: dict = field(default_factory=dict)
    cast_failures: dict = field(default_factory=dict)
    duplicates: int | None = None
    quarantined: int | None = None


AUDIT_SCHEMA = T.StructType([
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("row_count", T.LongType(), False),
])


def ingest_table(spark: SparkSession, csv_path: str, spec: TableSpec, out_path: str, *,
                 multiline: bool = False, quarantine_path: str | None = None) -> IngestResult:
    """CSV -> typed Parquet (overwrite) with its ingest metrics."""
    raw = read_csv_raw(spark, csv_path, spec, multiline=multiline,
                       quarantine=quarantine_path is not None)
    quarantined = None
    if quarantine_path is not None:
        raw, bad = split_quarantine(raw, f"{quarantine_path}/bronze")
        bad_obs = Observation(f"quarantine_{spec.name}")
        bad.observe(bad_obs, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").parquet(f"{quarantine_path}/rows")
        quarantined = int(bad_obs.get["rows"])
    obs = Observation(f"ingest_{spec.name}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"null__{c}")
                for c in spec.required]
    metrics += cast_failure_metrics(spec)
    observed = raw.observe(obs, *metrics)
    replace_parquet(coerce(observed, spec), out_path)
    m = obs.get
    rows = int(m["rows"])
    res = IngestResult(
        table=spec.name, path=out_path, rows=rows,
        parity_ok=None if spec.expected_rows is None else rows == spec.expected_rows,
        null_counts={c: int(m[f"null__{c}"] or 0) for c in spec.required},
        cast_failures={k.split("__", 1)[1]: int(v or 0) for k, v in m.items()
                       if k.startswith("cast_fail__")},
        quarantined=quarantined)
    if spec.dedup:
        typed = read_table(spark, out_path, spec.schema)
        res.duplicates = duplicate_count(typed, spec.dedup)
    return res


def ingest_all(spark: SparkSession, source_dir: str, specs: Mapping[str, TableSpec],
               files: Mapping[str, str], out_root: str, *, audit_path: str | None = None,
               quarantine_root: str | None = None,
               multiline: frozenset = frozenset(), max_parallel: int = 4) -> dict[str, IngestResult]:
    """Ingest every table; write an audit table replaced on each run (S-07, S-08).

    Tables are independent, so up to ``max_parallel`` of them are submitted as
    concurrent Spark jobs: small dimension tables then share the executors
    instead of running one after another.  Each table is still written and
    swapped in on its own; a failure raises after the running ones finish.
    """
    def one(name: str) -> IngestResult:
        return ingest_table(
            spark, f"{source_dir.rstrip('/')}/{files[name]}", specs[name], f"{out_root}/{name}",
            multiline=name in multiline,
            quarantine_path=None if quarantine_root is None else f"{quarantine_root}/{name}")

    names = list(specs)
    results = dict(zip(names, run_concurrently([(one, n) for n in names], max_parallel)))
    if audit_path is not None:
        now = _dt.datetime.now()
        spark.createDataFrame([(now, r.table, r.rows) for r in results.values()], AUDIT_SCHEMA) \
            .write.mode("overwrite").parquet(audit_path)
    return results
