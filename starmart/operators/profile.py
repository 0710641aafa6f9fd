"""Data-quality profiles (Q-01, Q-02, A-08, A-09).

All NULL counts of a table come from one aggregate pass; the result is turned
into one row per column with ``unpivot``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 table: str | None = None) -> DataFrame:
    """One row per column: ``[table_name,] column_name, null_count`` (bigint)."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                    for c in cols])
    long = wide.unpivot([], cols, "column_name", "null_count")
    if table is not None:
        long = long.select(F.lit(table).alias("table_name"), "column_name", "null_count")
    return long


def duplicate_profile(df: DataFrame, column: str, table: str | None = None) -> DataFrame:
    """``total_rows``, ``distinct_values`` (non-NULL) and their difference.

    NULL rows count as duplicates, as in the reference's ingest log.  The
    distinct count is exact; Spark de-duplicates map side first, so one very
    frequent value costs one row per task before the shuffle.
    """
    out = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.countDistinct(F.col(column)).alias("distinct_values"))
    out = out.select(F.lit(column).alias("column_name"), "total_rows", "distinct_values",
                     (F.col("total_rows") - F.col("distinct_values")).alias("duplicate_count"))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), *out.columns)
    return out


def duplicate_count(df: DataFrame, column: str) -> int:
    """Scalar form of ``duplicate_profile`` (one small row to the driver)."""
    return int(duplicate_profile(df, column).first()["duplicate_count"])


def row_count(df: DataFrame) -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame (A-08)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
