"""Star / snowflake join of a fact with its dimensions (J-01 ... J-07).

Join strategy is left to Catalyst + AQE: a dimension that is small at run
time is broadcast, a large one is joined sort-merge and AQE splits a skewed
fact partition (a hot foreign key) into several tasks.  An explicit broadcast
is only placed behind a row-count check (``bounded_broadcast``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Dim:
    """One dimension of a star.

    ``fact_key`` / ``dim_key``: join columns (equal length); ``columns``: the
    dimension columns to keep (``None`` keeps all but the key);
    ``broadcast_max_rows``: broadcast only if the dimension is proven to hold
    at most this many rows.
    """

    df: DataFrame
    fact_key: str | Sequence[str]
    dim_key: str | Sequence[str]
    columns: Sequence[str] | None = None
    broadcast_max_rows: int | None = None
    name: str = field(default="dim")
    skew_buckets: int = 0
    hot_fraction: float = 0.01


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows now.

    ``limit(max_rows + 1).count()`` lets every task stop after
    ``max_rows + 1`` rows, so the check stays cheap on a large input.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when the row count is proven to be small."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def star_join(fact: DataFrame, dims: Sequence[Dim], how: str = "inner") -> DataFrame:
    """Join ``fact`` with each dimension in turn on its declared keys.

    Inner joins drop facts without a matching dimension row (an orphan key,
    or a dimension row removed by a filter such as the current-row filter).
    Dimension keys must be unique (check with ``checks.unique_failures``) so
    the join never multiplies fact rows.
    """
    out = fact
    for d in dims:
        fk, dk = _keys(d.fact_key), _keys(d.dim_key)
        if len(fk) != len(dk):
            raise ValueError(f"{d.name}: key lengths differ: {fk} vs {dk}")
        keep = list(d.columns) if d.columns is not None else [c for c in d.df.columns if c not in dk]
        right = d.df.select(*dk, *[c for c in keep if c not in dk])
        if d.broadcast_max_rows is not None:
            right = bounded_broadcast(right, d.broadcast_max_rows)
        if d.skew_buckets > 1:
            out = salted_join(out, right, fk, dk, d.skew_buckets, d.hot_fraction, how, d.name)
            continue
        if fk == dk:
            out = out.join(right, on=fk, how=how)
        else:
            # Rename the dimension key so the fact key survives unambiguously.
            renamed = {k: f"__{d.name}_{k}" for k in dk}
            for k, nk in renamed.items():
                right = right.withColumnRenamed(k, nk)
            cond = [out[a] == right[renamed[b]] for a, b in zip(fk, dk)]
            out = out.join(right, on=cond, how=how).drop(*renamed.values())
    return out


def hot_keys(df: DataFrame, keys: Sequence[str], fraction: float) -> list[tuple]:
    """Key values holding at least ``fraction`` of the rows of ``df``.

    At most ``1 / fraction`` values can qualify, so only that many candidates
    (the most frequent keys) and the total row count reach the driver, both
    from one job: per-key counts are aggregated map side first, and the
    candidates and the total read the same shuffle (Spark reuses the
    identical exchange within one plan), so ``df`` is computed once.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    top = (counts.where(_all_not_null(keys)).orderBy(F.desc("__n"))
           .limit(int(1 / fraction) + 1)
           .select(F.lit(False).alias("__total"), "__n", *keys))
    total = counts.agg(F.sum("__n").alias("__n")).select(
        F.lit(True).alias("__total"), "__n",
        *[F.lit(None).cast(counts.schema[k].dataType).alias(k) for k in keys])
    rows = top.unionByName(total).collect()
    n_rows = next((r["__n"] for r in rows if r["__total"]), None) or 0
    threshold = max(1, int(n_rows * fraction))
    return [tuple(r[k] for k in keys) for r in rows
            if not r["__total"] and r["__n"] >= threshold]


def _all_not_null(keys):
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def salted_join(fact: DataFrame, dim: DataFrame, fact_key: Sequence[str],
                dim_key: Sequence[str], buckets: int = 16, hot_fraction: float = 0.01,
                how: str = "inner", name: str = "dim") -> DataFrame:
    """Equi-join that splits hot keys over ``buckets`` tasks (explicit skew handling).

    Fact rows of a hot key get a deterministic salt (hash of the row) in
    ``[0, buckets)``; only the dimension rows of hot keys are replicated once
    per salt.  Every other key keeps salt 0 and joins as usual, so the result
    is exactly the plain join.  Use where AQE's skew split is unavailable or
    when one key alone exceeds what a task can hold.
    """
    hot = hot_keys(fact, fact_key, hot_fraction)
    if not hot:
        plain = Dim(dim, fact_key, dim_key, [c for c in dim.columns if c not in dim_key],
                    name=name)
        return star_join(fact, [plain], how)

    def is_hot(cols):
        if len(cols) == 1:  # one key column: a set lookup (InSet) instead of an OR chain
            return F.col(cols[0]).isin([v[0] for v in hot])
        cond = None
        for values in hot:
            row = None
            for c, v in zip(cols, values):
                e = F.col(c) == F.lit(v)
                row = e if row is None else row & e
            cond = row if cond is None else cond | row
        return cond

    salt = f"__salt_{name}"
    row_hash = F.xxhash64(*[F.col(c) for c in fact.columns])
    f = fact.withColumn(salt, F.when(is_hot(fact_key), F.pmod(row_hash, F.lit(buckets)))
                        .otherwise(F.lit(0)).cast("int"))
    d = dim.withColumn(salt, F.when(is_hot(dim_key),
                                    F.sequence(F.lit(0), F.lit(buckets - 1)))
                       .otherwise(F.array(F.lit(0))))
    d = d.withColumn(salt, F.explode(F.col(salt)))
    renamed = {k: f"__{name}_{k}" for k in dim_key}
    for k, nk in renamed.items():
        d = d.withColumnRenamed(k, nk)
    cond = [f[a] == d[renamed[b]] for a, b in zip(fact_key, dim_key)] + [f[salt] == d[salt]]
    out = f.join(d, on=cond, how=how).drop(*renamed.values()).drop(f[salt]).drop(d[salt])
    if list(fact_key) == list(dim_key):  # same column order as a join on key names
        rest = [c for c in out.columns if c not in fact_key]
        out = out.select(*fact_key, *rest)
    return out
