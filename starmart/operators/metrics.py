"""Grouped metric tables with shares of a total (A-01 ... A-07, W-01 ... W-03).

Aggregation runs partial (map side) then final, so a hot group costs one
row per map task before the shuffle.  Share windows run over the *grouped*
rows only, whose number is bounded by the product of the key cardinalities.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.numeric import dround


def grouped_metrics(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[Column],
                    count_name: str = "record_count",
                    shares: Mapping[str, Sequence[str]] | None = None,
                    share_digits: int = 2, columns: Sequence[str] | None = None) -> DataFrame:
    """``GROUP BY keys`` with ``COUNT(*)``, the given measures and shares.

    ``shares`` maps an output name to the columns of its window partition:
    ``{}`` / ``()`` is the grand total (``SUM(COUNT(*)) OVER ()``).
    Shares are DOUBLE percentages rounded like the reference.  ``columns``
    fixes the output column order.
    """
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), *measures)
    for name, part in (shares or {}).items():
        w = Window.partitionBy(*part) if part else Window.partitionBy()
        total = F.sum(F.col(count_name)).over(w)
        out = out.withColumn(
            name, dround(F.col(count_name).cast("double") * F.lit(100.0) / total.cast("double"),
                         share_digits))
    if columns is not None:
        out = out.select(*columns)
    return out


def reaggregate(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str],
                rounded: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """Roll a metric table up to fewer keys: ``SUM`` of counts and of shares.

    ``sums``: output -> input column summed as is (counts, bigint);
    ``rounded``: output -> (input, digits), summed then rounded (a sum of
    rounded shares, as the class-balance view does).
    """
    aggs = [F.sum(F.col(src)).cast("long").alias(out) for out, src in sums.items()]
    for out, (src, digits) in (rounded or {}).items():
        aggs.append(dround(F.sum(F.col(src).cast("double")), digits).alias(out))
    return df.groupBy(*keys).agg(*aggs)
