"""Monitoring checks: class thresholds, distribution drift, freshness (T2-10, T3-03, T3-04).

Each compares aggregated profiles, so only grouped rows (bounded by the
number of categories) meet in a join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.dates import as_of_date
from starmart.functions.numeric import dround
from starmart.operators.paging import KeyIndex


def class_thresholds(balance: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None,
                     default: tuple[float, float] = (0.0, 100.0), class_col: str = "health_condition",
                     share_col: str = "pct_of_total") -> DataFrame:
    """Each class share against its ``(min_pct, max_pct)`` bounds."""
    lo_expr, hi_expr = F.lit(float(default[0])), F.lit(float(default[1]))
    for cls, (lo, hi) in (bounds or {}).items():
        lo_expr = F.when(F.col(class_col) == F.lit(cls), F.lit(float(lo))).otherwise(lo_expr)
        hi_expr = F.when(F.col(class_col) == F.lit(cls), F.lit(float(hi))).otherwise(hi_expr)
    return balance.select("*", lo_expr.alias("min_pct"), hi_expr.alias("max_pct")).withColumn(
        "within_bounds", (F.col(share_col) >= F.col("min_pct")) & (F.col(share_col) <= F.col("max_pct")))


def category_shares(df: DataFrame, col: str, name: str) -> DataFrame:
    """Share of each category value in ``df`` (NULL counted as its own value).

    The total is a window over the grouped rows (one per category).
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(f"{name}_count"))
    total = F.sum(f"{name}_count").over(Window.partitionBy())
    return counts.withColumn(f"{name}_share", F.col(f"{name}_count").cast("double") / total)


def psi(baseline: DataFrame, current: DataFrame, col: str, epsilon: float = 1e-4,
        digits: int = 6) -> DataFrame:
    """Population stability index per category of ``col`` (T3-03).

    ``term = (cur - base) * ln(cur / base)`` with shares floored at
    ``epsilon``; the sum of the terms is the PSI.  A category missing on one
    side has share 0 there.
    """
    b = category_shares(baseline, col, "base").withColumnRenamed(col, "__base_key")
    c = category_shares(current, col, "cur").withColumnRenamed(col, "__cur_key")
    j = b.join(c, F.col("__base_key").eqNullSafe(F.col("__cur_key")), how="full_outer") \
        .select(F.coalesce("__base_key", "__cur_key").alias(col), "base_count", "base_share",
                "cur_count", "cur_share")
    base = F.greatest(F.coalesce(F.col("base_share"), F.lit(0.0)), F.lit(epsilon))
    cur = F.greatest(F.coalesce(F.col("cur_share"), F.lit(0.0)), F.lit(epsilon))
    return j.select(
        col,
        F.coalesce(F.col("base_count"), F.lit(0)).cast("long").alias("base_count"),
        F.coalesce(F.col("cur_count"), F.lit(0)).cast("long").alias("cur_count"),
        dround(base, digits).alias("base_share"), dround(cur, digits).alias("cur_share"),
        dround((cur - base) * F.log(cur / base), digits).alias("psi_term"))


def exact_quantiles(df: DataFrame, col: str, shares: Sequence[float]) -> list:
    """The value at place ``ceil(share * n)`` (from 1) of the sorted non-NULL values, for each share.

    Found by row counts of key ranges: no task sorts more than a small range.
    An empty column gives an empty list.
    """
    values = df.where(F.col(col).isNotNull()).select(col)
    index = KeyIndex(values, [col])
    n = index.all.rows
    if not n:
        return []
    places = [min(n, max(1, math.ceil(share * n))) for share in shares]
    return [index.page(1, place - 1).first()[0] for place in places]


def numeric_bin(col: str, bounds: Sequence) -> Column:
    """Bin of a number: i for ``bounds[i - 1] < value <= bounds[i]``, the first bin with its lower
    end, 0 below the first bound, the next number above the last, NULL for NULL."""
    c = F.col(col)
    out = F.when(c.isNull(), F.lit(None).cast("int"))
    if not bounds:
        return out.otherwise(F.lit(1))
    out = out.when(c < F.lit(bounds[0]), F.lit(0))
    for i, high in enumerate(bounds[1:], 1):
        out = out.when(c <= F.lit(high), F.lit(i))
    return out.when(c <= F.lit(bounds[-1]), F.lit(1)).otherwise(F.lit(max(2, len(bounds))))


def psi_numeric(baseline: DataFrame, current: DataFrame, col: str, bins: int = 10,
                epsilon: float = 1e-4, digits: int = 6) -> DataFrame:
    """Population stability index of a numeric column, by bin (T3-03).

    The baseline's exact quantiles bound the bins (equal ones are one bound);
    values below its least, above its greatest and NULLs have bins of their
    own.  A bin without rows on both sides gives no row.
    """
    shares = [i / bins for i in range(bins + 1)]
    bounds: list = []
    for v in exact_quantiles(baseline, col, shares):
        if not bounds or v > bounds[-1]:
            bounds.append(v)
    place = numeric_bin(col, bounds).alias("bin")
    return psi(baseline.select(place), current.select(place), "bin", epsilon, digits)


def completeness(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Non-NULL share per column in one pass (for completeness drift)."""
    total = F.count(F.lit(1))
    wide = df.agg(*[(F.count(F.col(c)).cast("double") / total).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", f"{name}_complete")


def freshness(df: DataFrame, table: str, date_col: str, as_of, max_lag_days: int) -> DataFrame:
    """Latest date in ``date_col`` against ``as_of - max_lag_days`` (T3-04)."""
    d = as_of_date(as_of)
    latest = df.agg(F.max(F.col(date_col).cast("date")).alias("latest_date"))
    return latest.select(
        F.lit(table).alias("table_name"), F.lit(date_col).alias("column_name"),
        "latest_date", d.alias("as_of"),
        F.datediff(d, F.col("latest_date")).alias("lag_days"),
        F.lit(int(max_lag_days)).alias("max_lag_days"),
        (F.datediff(d, F.col("latest_date")) <= F.lit(int(max_lag_days))).alias("fresh"))
