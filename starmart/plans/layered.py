"""Bronze, silver and gold in one run, published behind a gate (T2-17, Q-05).

Tables of all layers are written as new versions.  Only if the declared checks
of the gold tables pass, a manifest that names these versions is published;
readers go by the manifest, so a run that fails its gate changes nothing for
them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.checks import CheckFailed, CheckSpec, gate, run_checks
from starmart.session import run_concurrently
from starmart.sources.layers import read_table, replace_parquet

LAYERS = ("bronze", "silver", "gold")
Build = Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


@dataclass
class LayeredRun:
    """What a run wrote and whether it was published."""

    tables: dict[str, dict[str, DataFrame]]
    report: DataFrame
    published: bool
    reason: str


def _write(spark: SparkSession, root: str, run_id: str, layer: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables of a layer, stored under this run and read back."""
    run_concurrently([(lambda d, p: d.write.mode("overwrite").parquet(p), df, f"{root}/{layer}/{name}/{run_id}")
                      for name, df in tables.items()])
    return {name: spark.read.parquet(f"{root}/{layer}/{name}/{run_id}") for name in tables}


def run_layers(spark: SparkSession, root: str, run_id: str, sources: Mapping[str, DataFrame], silver: Build,
               gold: Build, checks: Mapping[str, CheckSpec]) -> LayeredRun:
    """Each layer is built from the stored one before it; a run given again under its id writes the same folders."""
    stored = {"bronze": _write(spark, root, run_id, "bronze", sources)}
    stored["silver"] = _write(spark, root, run_id, "silver", silver(stored["bronze"]))
    stored["gold"] = _write(spark, root, run_id, "gold", gold(stored["silver"]))
    report = run_checks(stored["gold"], checks)
    replace_parquet(report, f"{root}/reports/{run_id}")
    report = read_table(spark, f"{root}/reports/{run_id}")
    try:
        gate(report)
    except CheckFailed as failed:
        return LayeredRun(stored, report, False, str(failed))
    # One row a table.
    entries = [(run_id, layer, name, f"{root}/{layer}/{name}/{run_id}") for layer in LAYERS for name in stored[layer]]
    replace_parquet(spark.createDataFrame(entries, "run_id string, layer string, table_name string, path string").coalesce(1),
                    f"{root}/manifest")
    return LayeredRun(stored, report, True, "")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """run_id, layer, table_name and path of the published tables."""
    return read_table(spark, f"{root}/manifest")


def published_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A table of the last run that passed its gate."""
    entry = manifest(spark, root).where((F.col("layer") == layer) & (F.col("table_name") == name)).first()
    if entry is None:
        raise LookupError(f"{layer}.{name} isn't published")
    return spark.read.parquet(entry["path"])


def published_counts(spark: SparkSession, root: str) -> DataFrame:
    """run_id, layer, table_name and row_count of all published tables."""
    out = None
    for e in manifest(spark, root).collect():  # one row a table
        one = spark.read.parquet(e["path"]).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(e["run_id"]).alias("run_id"), F.lit(e["layer"]).alias("layer"),
            F.lit(e["table_name"]).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
