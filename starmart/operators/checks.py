"""Declared data checks and the publication gate (Q-03 ... Q-05, T2-07 ... T2-11).

A check report has one row per check::

    model, column_name, check_name, failures

All row-level checks of a table (not_null, accepted_values, range) are folded
into a single global aggregate, combined map side.  A ``unique`` key costs one
grouped count of the key alone, several of them one scan together; each ``relationships`` check one
left-anti join of the distinct child keys, both combined map side first, so
that a hot value is one row for each task.  A model that is expensive to
compute should be stored before it is checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("model", "column_name", "check_name", "failures")


class CheckFailed(RuntimeError):
    """Raised by ``gate`` when a check has failures."""


@dataclass
class CheckSpec:
    """Checks declared on one model."""

    unique: Sequence[str | Sequence[str]] = ()
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple] = field(default_factory=dict)


def _name(c) -> str:
    return c if isinstance(c, str) else "+".join(c)


def unique_failures(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Non-NULL key values that occur more than once, with ``n_rows``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    nonnull = None
    for c in cols:
        cond = F.col(c).isNotNull()
        nonnull = cond if nonnull is None else nonnull & cond
    return (df.where(nonnull).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def unique_report(df: DataFrame, model: str, keys: Sequence[str | Sequence[str]]) -> DataFrame:
    """Report rows of many unique keys from one scan: one Expand over the key sets,
    counted by (key set, key) with partial counts, so that a hot key - or the
    NULLs, which are no failures - costs one row for each task.

    Columns model, column_name, check_name, failures (key values that occur
    more than once) and surplus_rows (rows beyond the first of each).
    """
    sets = [[k] if isinstance(k, str) else list(k) for k in keys]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    keyed = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("key_set"),
                 *[(F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(f"k{j}")
                   for j, c in enumerate(columns)])
        for i, s in enumerate(sets)])).alias("e")).select("e.*")
    whole = F.lit(False)
    for i, s in enumerate(sets):
        held = F.col("key_set") == i
        for c in s:
            held = held & F.col(f"k{columns.index(c)}").isNotNull()
        whole = whole | held
    counted = keyed.where(whole).groupBy("key_set", *[f"k{j}" for j in range(len(columns))]) \
        .agg(F.count(F.lit(1)).alias("n"))
    more = F.col("n") > 1
    found = counted.groupBy("key_set").agg(F.sum(F.when(more, 1).otherwise(0)).alias("failures"),
                                           F.sum(F.col("n") - 1).alias("surplus_rows"))
    names = df.sparkSession.createDataFrame([(i, _name(s if len(s) > 1 else s[0])) for i, s in enumerate(sets)],
                                            "key_set int, column_name string")
    return names.join(found, "key_set", "left").select(
        F.lit(model).alias("model"), "column_name", F.lit("unique").alias("check_name"),
        F.coalesce("failures", F.lit(0)).cast("long").alias("failures"),
        F.coalesce("surplus_rows", F.lit(0)).cast("long").alias("surplus_rows"))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_value_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the domain (NULL is not a failure)."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def range_failures(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Rows outside ``[lo, hi]`` (NULL is not a failure)."""
    return df.where(_out_of_range(F.col(column), lo, hi))


def _out_of_range(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return c.isNotNull() & cond


def relationship_failures(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
                          parent_key: str | Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left-anti join)."""
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    pk = [parent_key] if isinstance(parent_key, str) else list(parent_key)
    p = parent.select(*[F.col(a).alias(f"__p_{i}") for i, a in enumerate(pk)])
    cond = [child[a] == p[f"__p_{i}"] for i, a in enumerate(ck)]
    nonnull = None
    for a in ck:
        c = F.col(a).isNotNull()
        nonnull = c if nonnull is None else nonnull & c
    return child.where(nonnull).join(p, on=cond, how="left_anti")


def relationship_failure_count(child: DataFrame, parent: DataFrame,
                               child_key: str | Sequence[str],
                               parent_key: str | Sequence[str]) -> DataFrame:
    """One row, ``failures``: child rows whose non-NULL key has no parent row.

    Rows are counted by key before the join, so no child row is shuffled.
    """
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    counted = child.groupBy(*ck).agg(F.count(F.lit(1)).alias("__rows"))
    bad = relationship_failures(counted, parent, ck, parent_key)
    return bad.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("failures"))


def _row_check_exprs(spec: CheckSpec) -> tuple[list[Column], list[tuple[str, str]]]:
    """Per-row failure indicators (0/1) of the row-level checks, with their labels."""
    flags, meta = [], []
    for c in spec.not_null:
        flags.append(F.col(c).isNull())
        meta.append((c, "not_null"))
    for c, values in spec.accepted.items():
        flags.append(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
        meta.append((c, "accepted_values"))
    for c, (lo, hi) in spec.ranges.items():
        flags.append(_out_of_range(F.col(c), lo, hi))
        meta.append((c, "range"))
    return [F.when(f, 1).otherwise(0) for f in flags], meta


def _stack(wide: DataFrame, model: str, meta: Sequence[tuple[str, str]],
           names: Sequence[str]) -> DataFrame:
    """One wide row of counts -> one report row per check."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(col).alias("column_name"), F.lit(check).alias("check_name"),
                 F.col(n).alias("failures"))
        for (col, check), n in zip(meta, names)]))
    return wide.select(stacked.alias("r")).select(
        F.lit(model).alias("model"), "r.column_name", "r.check_name", "r.failures")


def _row_checks(df: DataFrame, model: str, spec: CheckSpec) -> DataFrame | None:
    """not_null, accepted and range checks of one model in one aggregate pass."""
    flags, meta = _row_check_exprs(spec)
    if not flags:
        return None
    names = [f"c{i}" for i in range(len(flags))]
    wide = df.agg(*[F.coalesce(F.sum(f), F.lit(0)).cast("long").alias(n)
                    for f, n in zip(flags, names)])
    return _stack(wide, model, meta, names)


def run_checks(tables: Mapping[str, DataFrame], specs: Mapping[str, CheckSpec]) -> DataFrame:
    """Report of all declared checks of all models (one row per check)."""
    parts = []
    for model, spec in specs.items():
        df = tables[model]
        rows = _row_checks(df, model, spec)
        if rows is not None:
            parts.append(rows)
        if len(spec.unique) > 1:
            parts.append(unique_report(df, model, spec.unique).drop("surplus_rows"))
        for key in spec.unique if len(spec.unique) == 1 else ():
            failures = unique_failures(df, key).agg(F.count(F.lit(1)).cast("long").alias("f"))
            parts.append(failures.select(F.lit(model).alias("model"),
                                         F.lit(_name(key)).alias("column_name"),
                                         F.lit("unique").alias("check_name"),
                                         F.col("f").alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(report: DataFrame) -> DataFrame:
    """Stop publication when any check failed (Q-05).

    Only failing report rows (bounded by the number of declared checks) are
    brought to the driver.
    """
    bad = report.where(F.col("failures") > 0).collect()
    if bad:
        detail = ", ".join(f"{r.model}.{r.column_name} {r.check_name}={r.failures}" for r in bad)
        raise CheckFailed(f"{len(bad)} check(s) failed: {detail}")
    return report


# Patterns that look like personal data in free text (PII scan).  Numbers must
# stand alone, so digit runs inside hashes or codes do not count.  No
# look-around, so the same patterns run in other regex engines.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"(^|[^0-9A-Za-z])\+?[0-9][0-9 -]{7,}[0-9]([^0-9A-Za-z]|$)",
    "national_id": r"(^|[^0-9A-Za-z])[0-9]{9,14}([^0-9A-Za-z]|$)",
}

# What Spark's engine (Java) searches for in place of those patterns.  Each is found in the
# same values, only what surrounds a finding is left out: it starts at one character of
# a fixed kind (the @, the first digit) and looks back from there, so a text is read once,
# without groups, and a long word is not read again from each of its characters.
_SEARCHED = {
    PII_PATTERNS["email"]: r"@(?<=[A-Za-z0-9._%+-]@)[A-Za-z0-9.-]+\.[A-Za-z]{2}",
    # A plus sign is no digit or letter, so it need not be told from what may stand before.
    PII_PATTERNS["phone"]: r"[0-9](?<![0-9A-Za-z][0-9])[0-9 -]{7,}[0-9](?![0-9A-Za-z])",
    PII_PATTERNS["national_id"]: r"[0-9](?<![0-9A-Za-z][0-9])[0-9]{8,13}(?![0-9A-Za-z])",
}


def pii_scan(df: DataFrame, model: str, forbidden_columns: Sequence[str] = (),
             patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Raw PII columns present in a published schema, and string values that
    match a PII pattern, counted per column in one pass (T2-11)."""
    spark = df.sparkSession
    present = [c for c in forbidden_columns if c.lower() in {x.lower() for x in df.columns}]
    schema_rows = spark.createDataFrame(
        [(model, c, "pii_column_present", 1) for c in present],
        "model string, column_name string, check_name string, failures bigint")
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not str_cols:
        return schema_rows
    exprs, meta = [], []
    for c in str_cols:
        for pname, pat in patterns.items():
            exprs.append(F.sum(F.when(F.col(c).rlike(_SEARCHED.get(pat, pat)), 1).otherwise(0)).cast("long"))
            meta.append((c, f"pii_pattern_{pname}"))
    names = [f"p{i}" for i in range(len(exprs))]
    wide = df.agg(*[F.coalesce(e, F.lit(0)).alias(n) for e, n in zip(exprs, names)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(col).alias("column_name"), F.lit(check).alias("check_name"),
                 F.col(n).alias("failures")) for (col, check), n in zip(meta, names)]))
    values = wide.select(stacked.alias("r")).select(
        F.lit(model).alias("model"), "r.column_name", "r.check_name", "r.failures")
    return schema_rows.unionByName(values)

