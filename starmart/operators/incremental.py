"""Incremental load: merge new or changed rows into a table (T3-01).

``merge`` keeps target rows whose key is not in the batch (left-anti join)
and adds the batch's latest version of every key.  Both steps are shuffles
on the key; nothing is collected.  ``write_partitions`` replaces only the
partitions present in the batch (dynamic partition overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.scd import latest


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str],
          version: Sequence[str] | None = None) -> DataFrame:
    """Upsert ``batch`` into ``target`` by ``keys``.

    With ``version`` columns, only the newest batch row per key is kept;
    without, the batch must already hold one row per key.
    """
    newest = latest(batch, keys, version) if version else batch
    newest = newest.select(*target.columns)
    kept = target.join(newest.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(newest)


def changed_rows(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of ``current`` that are new or differ from ``previous`` (whole row)."""
    return current.exceptAll(previous.select(*current.columns))


def after_watermark(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows strictly after the last loaded value of ``column``."""
    return df.where(F.col(column) > F.lit(watermark))


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
