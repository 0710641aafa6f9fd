"""Metrics kept as mergeable states and brought up to date by batches (T3-01).

A state holds, for each group, the row count and for each measure exact and
plain sums, sums of squares, least and greatest value: everything that count,
sum, average, minimum, maximum and standard deviation need.  States of disjoint
rows merge by adding, in any order, so a load reads only its batch and the
partitions that the batch touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.numeric import sample_stddev, square_parts, sum_parts, sum_value
from starmart.operators.incremental import write_partitions
from starmart.session import path_exists, scratch_path

_ADDED = ("exact", "plain", "n", "fit", "squares", "plain_squares", "square_fit")


def group_states(df: DataFrame, group: Sequence[str], measures: Sequence[str], version: str) -> DataFrame:
    """One state for each group; ``loaded_to`` is the greatest ``version`` in it."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.max(version).alias("loaded_to")]
    for m in measures:
        aggs += [*sum_parts(m, m), *square_parts(m, m), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    out = df.groupBy(*group).agg(*aggs)
    # A group without an exact value has an empty sum, which must not undo that of another state.
    for m in measures:
        for part, fit in (("exact", "fit"), ("squares", "square_fit")):
            c = f"{m}_{part}"
            empty = F.lit(0).cast(out.schema[c].dataType)
            out = out.withColumn(c, F.when(F.col(f"{m}_{fit}") == 0, empty).otherwise(F.col(c)))
    return out


def merge_states(states: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """States of the same groups added up.  A sum that overflows is NULL and stays so."""
    aggs = [F.sum("n_rows").alias("n_rows"), F.max("loaded_to").alias("loaded_to")]
    for m in measures:
        for part in _ADDED:
            c = f"{m}_{part}"
            total = F.try_sum(c).cast(states.schema[c].dataType) if part in ("exact", "squares") else F.sum(c)
            lost = F.max(F.col(c).isNull())
            aggs.append((F.when(~lost, total) if part in ("exact", "squares") else total).alias(c))
        aggs += [F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    return states.groupBy(*group).agg(*aggs).select(*states.columns)


def finish_states(states: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """n_rows and for each measure sum, avg, min, max and sample standard deviation."""
    out = [*group, "n_rows"]
    for m in measures:
        total = sum_value(f"{m}_exact", f"{m}_plain", f"{m}_n", f"{m}_fit")
        n = F.nullif(F.col(f"{m}_n"), F.lit(0)).cast("double")
        deviation = sample_stddev(*[f"{m}_{p}" for p in _ADDED])
        out += [F.when(n.isNotNull(), total).alias(f"{m}_sum"), (total / n).alias(f"{m}_avg"),
                f"{m}_min", f"{m}_max", deviation.alias(f"{m}_stddev")]
    return states.select(*out)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def load(spark: SparkSession, path: str, batch: DataFrame, group: Sequence[str], measures: Sequence[str],
         version: str, partition_by: Sequence[str]) -> None:
    """Merge the rows of ``batch`` above the watermark into the state table at ``path``.

    Each partition (``partition_by``, some of ``group``) keeps how far it is
    loaded, the greatest ``version`` in it; rows up to there count already.  A
    load that failed half-way or is given again therefore adds nothing twice:
    partitions are replaced whole, each with its own watermark.  ``version``
    must grow from load to load and not be NULL (raises).
    """
    given = F.when(F.col(version).isNull(), F.raise_error(F.lit(f"NULL {version}"))).otherwise(F.col(version))
    batch = batch.withColumn(version, given)
    schema = group_states(batch, group, measures, version).schema
    if path_exists(spark, path):
        stored = spark.read.schema(schema).parquet(path)
        marks = stored.groupBy(*partition_by).agg(F.max("loaded_to").alias("__mark"))
        joined = batch.join(marks, _same(batch, marks, partition_by), "left")
        fresh = joined.where(F.col("__mark").isNull() | (F.col(version) > F.col("__mark"))).select(*[batch[c] for c in batch.columns])
        new = group_states(fresh, group, measures, version)
        at = scratch_path(spark, "new-states")
        new.write.parquet(at)
        new = spark.read.parquet(at)
        touched = new.select(*partition_by).distinct()
        kept = stored.join(touched, _same(stored, touched, partition_by), "left_semi")
        merged = merge_states(kept.select(*new.columns).unionByName(new), group, measures)
    else:
        merged = group_states(batch, group, measures, version)
    # What is read and what is replaced are the same folders: written aside first.
    at = scratch_path(spark, "merged-states")
    merged.write.parquet(at)
    write_partitions(spark.read.parquet(at).repartition(*partition_by), path, partition_by)


def read_states(spark: SparkSession, path: str, batch: DataFrame, group: Sequence[str], measures: Sequence[str],
                version: str) -> DataFrame:
    """The stored states, with the column types that ``batch`` gives them."""
    return spark.read.schema(group_states(batch, group, measures, version).schema).parquet(path)
