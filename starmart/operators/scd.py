"""Slowly changing dimension (type 2) views (F-01, T2-03).

``latest`` and ``as_of`` pick one version per key with a ``max_by``-style
aggregate (``max`` over a struct), which aggregates partially before the
shuffle: a key with millions of versions costs one row per map task, never a
whole group in one task as a per-key window would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.dates import as_of_date


def current(df: DataFrame, flag_col: str = "is_current", value: str = "YES") -> DataFrame:
    """Rows flagged current."""
    return df.where(F.col(flag_col) == F.lit(value))


def valid_at(df: DataFrame, as_of, start_col: str = "start_date",
             end_col: str = "end_date") -> DataFrame:
    """Versions valid on ``as_of``: ``start <= d AND (end IS NULL OR end > d)``."""
    d = as_of_date(as_of)
    return df.where((F.col(start_col) <= d) &
                    (F.col(end_col).isNull() | (F.col(end_col) > d)))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``order`` must make the choice unique (add a tie-breaking column).
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in others])
    best = df.groupBy(*keys).agg(F.max(packed).alias("__v"))
    return best.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in others])


def as_of(df: DataFrame, keys: Sequence[str], start_col: str, as_of_value,
          tie_break: Sequence[str] = ()) -> DataFrame:
    """Per key, the latest version that started on or before ``as_of_value``."""
    d = as_of_date(as_of_value)
    return latest(df.where(F.col(start_col).cast("date") <= d), keys, [start_col, *tie_break])


def derive_validity(df: DataFrame, keys: Sequence[str], start: str,
                    tie_break: Sequence[str] = (), end_col: str = "valid_to",
                    partitions: int | None = None) -> DataFrame:
    """History view: each version valid until the next version of its key starts.

    A per-key window would put all versions of a hot key into one task.
    Instead the rows are range-partitioned on (key, start, tie-break), so a
    hot key spreads over several partitions; ``lead`` runs inside each range
    partition, and the last row of a partition takes the first row of the
    next non-empty partition (one row per partition, broadcast).  The last
    version of every key gets NULL.  As in SQL's ``lead`` over NULLS LAST, a
    NULL key is a key of its own and a NULL start comes last.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [*keys, start, *tie_break]
    order = [F.asc_nulls_last(c) for c in names]
    # Materialised once (reliable checkpoint in spark.checkpoint.dir): both
    # uses below must see the same partition ids, whatever AQE re-plans.
    ranked = (df.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id())
              .checkpoint(eager=True))
    head = F.struct(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)])
    nxt = F.lead(head).over(Window.partitionBy("__pid").orderBy(*order))
    step = ranked.withColumn("__next", nxt)
    # First row of each range partition (NULLs last, so each column is led by
    # its NULL flag), and for each partition that of the next non-empty one
    # (bounded: one row per partition).
    led = F.struct(*[x for i, c in enumerate(names)
                     for x in (F.col(c).isNull().alias(f"__n{i}"), F.col(c).alias(f"__k{i}"))])
    firsts = step.groupBy("__pid").agg(F.min(led).alias("__f"))
    follow = firsts.select("__pid", F.lead("__f").over(Window.orderBy("__pid")).alias("__nf"))
    joined = step.join(F.broadcast(follow), "__pid", "left")  # one row per partition

    def ends(after: str):
        same = F.lit(True)
        for i, c in enumerate(keys):
            same = same & F.col(f"{after}.__k{i}").eqNullSafe(F.col(c))
        return F.when(same, F.col(f"{after}.__k{len(keys)}"))

    valid_to = (F.when(F.col("__next").isNotNull(), ends("__next"))
                .when(F.col("__nf").isNotNull(), ends("__nf")))
    return joined.select(*df.columns, valid_to.alias(end_col))


def point_in_time(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str,
                  end: str, columns: Sequence[str], tie_break: Sequence[str] = (),
                  partitions: int | None = None) -> DataFrame:
    """Every fact row with the version of its key that was valid on its own date.

    That is the version with the greatest ``start`` up to the fact's ``at`` (of
    equal starts the greatest ``tie_break``), unless its ``end`` is on or before
    ``at`` (NULL: still valid).  Without one - no version yet, a gap, a NULL key
    or date - ``columns`` and ``start`` and ``end`` are NULL; no fact row is lost.
    Output names must not clash with those of the facts.

    Versions and facts are range-partitioned together on (key, date), so the
    rows of a hot key spread over partitions, those of one date by a hash of
    the row.  In a partition every fact takes the last version before it; what
    a partition ends with is carried to the next ones (one row for each).
    """
    spark = facts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = [start, end, *columns]
    clash = set(taken) & set(facts.columns)
    if clash:
        raise ValueError(f"columns in both tables: {sorted(clash)}")
    able = F.col(at).isNotNull()
    for k in keys:
        able = able & F.col(k).isNotNull()
    key_names = [f"__k{i}" for i in range(len(keys))]
    tie_names = [f"__t{i}" for i in range(len(tie_break))]
    whole = F.struct(*[F.col(c) for c in facts.columns])
    dated = facts.where(able).select(
        *[F.col(k).alias(a) for k, a in zip(keys, key_names)], F.col(at).alias("__at"), F.lit(1).alias("__kind"),
        F.xxhash64(*facts.columns).alias("__salt"), whole.alias("__fact"))
    known = versions.where(F.col(start).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    version = F.struct(*[F.col(k).alias(a) for k, a in zip(keys, key_names)], F.col(start).alias("__start"),
                       *[F.col(c) for c in taken])
    known = known.select(
        *[F.col(k).alias(a) for k, a in zip(keys, key_names)], F.col(start).alias("__at"), F.lit(0).alias("__kind"),
        *[F.col(c).alias(a) for c, a in zip(tie_break, tie_names)], version.alias("__version"))
    rows = known.unionByName(dated, allowMissingColumns=True)
    order = [*key_names, "__at", "__kind", *tie_names, "__salt"]
    # Written once: the borders and the rows must come from the same partitions.
    placed = (rows.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id())
              .checkpoint(eager=True))
    within = Window.partitionBy("__pid").orderBy(*order)
    seen = placed.withColumn("__last", F.last("__version", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # The last version of every partition (the greatest in the order), then of all before it.
    ends = placed.where(F.col("__kind") == 0).groupBy("__pid").agg(
        F.max(F.struct(*key_names, "__at", *tie_names, "__version")).alias("__end"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.select("__pid").distinct().join(ends, "__pid", "left").select(
        "__pid", F.last("__end.__version", ignorenulls=True).over(before).alias("__carried"))
    joined = seen.where(F.col("__kind") == 1).join(F.broadcast(carried), "__pid", "left")  # one row a partition
    last = F.coalesce("__last", "__carried")
    joined = joined.withColumn("__found", last)
    valid = F.col(f"__found.{end}").isNull() | (F.col(f"__found.{end}") > F.col("__at"))
    for a in key_names:
        valid = valid & (F.col(f"__found.{a}") == F.col(a))
    out = joined.select(*[F.col(f"__fact.{c}") for c in facts.columns],
                        *[F.when(valid, F.col(f"__found.{c}")).alias(c) for c in taken])
    types = {f.name: f.dataType for f in out.schema}
    rest = facts.where(~F.coalesce(able, F.lit(False))).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in taken])
    return out.unionByName(rest)
