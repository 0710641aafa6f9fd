"""Per-entity time series: weekly means, trend direction, trajectories.

Raw rows are first aggregated per (entity, period) with partial aggregation,
so a very active entity is combined map side.  Windows (``lag``, running
totals) then run over the aggregated series, whose length per entity is
bounded by the number of periods, not by the entity's row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.dates import week_start
from starmart.functions.numeric import dround, exact_avg, sum_parts, sum_value


def weekly_means(df: DataFrame, entity: str, ts: str, value: str,
                 digits: int = 4) -> DataFrame:
    """Per entity and ISO week (Monday start): rows, exact mean of ``value``."""
    return (df.withColumn("week_start", week_start(ts))
            .groupBy(entity, "week_start")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 dround(exact_avg(value), digits).alias("avg_value")))


def trend_direction(weekly: DataFrame, entity: str, period: str = "week_start",
                    value: str = "avg_value", tolerance: float = 0.0,
                    labels: Sequence[str] = ("up", "flat", "down")) -> DataFrame:
    """Change against the entity's previous period and its direction.

    ``delta > tolerance`` -> up, ``delta < -tolerance`` -> down, else flat;
    the first period of an entity has no previous value (NULL direction).
    """
    w = Window.partitionBy(entity).orderBy(period)
    prev = F.lag(value).over(w)
    delta = dround(F.col(value) - prev, 4)
    up, flat, down = labels
    direction = (F.when(prev.isNull(), F.lit(None).cast("string"))
                 .when(delta > F.lit(tolerance), F.lit(up))
                 .when(delta < F.lit(-tolerance), F.lit(down))
                 .otherwise(F.lit(flat)))
    return weekly.select("*", prev.alias("prev_value"), delta.alias("delta"),
                         direction.alias("direction"))


def trajectory(df: DataFrame, entity: str, ts: str, value: str, digits: int = 4) -> DataFrame:
    """Daily series per entity with the running mean to date (T2-16).

    Daily totals are exact (``sum_parts``); the running mean is cumulative sum
    over cumulative count, so it does not depend on partitioning.
    """
    daily = (df.withColumn("day", F.col(ts).cast("date"))
             .groupBy(entity, "day")
             .agg(*sum_parts(value, "__v")))
    w = Window.partitionBy(entity).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    parts = ["__v_exact", "__v_plain", "__v_n", "__v_fit"]
    running = [F.try_sum(parts[0]).over(w), *[F.sum(c).over(w) for c in parts[1:]]]

    def mean(total, n):  # NULL where there is no value
        return dround(total / F.nullif(n, F.lit(0)).cast("double"), digits)

    return daily.select(
        entity, "day", F.col("__v_n").alias("n_rows"),
        mean(sum_value(*parts), F.col("__v_n")).alias("day_avg"),
        mean(sum_value(*running), running[2]).alias("running_avg"))


def active_per_period(df: DataFrame, entity: str, ts: str) -> DataFrame:
    """Distinct active entities per ISO week (T2-12).

    The distinct count shuffles on (week, entity) first, so a busy week is
    spread over many tasks and only partial counts meet per week.
    """
    return (df.withColumn("week_start", week_start(ts)).groupBy("week_start")
            .agg(F.countDistinct(entity).alias("active_entities"),
                 F.count(F.lit(1)).alias("n_rows")))
