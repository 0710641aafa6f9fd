"""Filtered, sorted and paged reads (F-03 ... F-05, O-03 ... O-05).

A page is ``ORDER BY keys LIMIT n OFFSET k`` over a total order, NULLs last.
For ``OFFSET k LIMIT n`` Spark keeps ``k + n`` rows of every partition and
merges them in one task.  Here every page, whatever its offset, is found by
``KeyIndex``: rows are counted by ranges of the key, the ranges that the page
touches are refined until they are small, and only their rows are read, by a
filter on the key that reaches the scan.  For a run of deep pages, keyset paging
(``after=``) needs no offset at all and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LIMIT = 500
DEFAULT_LIMIT = 50

#: Rows of a key range that one task may sort to cut a page out of it.
ROWS_AT_ONCE = 100_000
#: Bounds by which a range is divided, and sampled keys for each bound of a text key.
BOUNDS, SAMPLED = 64, 20


def validate_page(limit: int, offset: int) -> None:
    """Reference bounds: 1 <= limit <= 500, offset >= 0 (F-05)."""
    if not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}, got {limit!r}")
    if not isinstance(offset, int) or offset < 0:
        raise ValueError(f"offset must be >= 0, got {offset!r}")


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """AND of equality filters; a NULL or falsy value ('' or 0) means no filter."""
    cond = None
    for col, value in (filters or {}).items():
        if not value:
            continue
        c = F.col(col) == F.lit(value)
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def _order(keys: Sequence[str | Column]) -> list[Column]:
    return [F.asc_nulls_last(k) if isinstance(k, str) else k for k in keys]


def after_key(keys: Sequence[str], after: Sequence) -> Column:
    """Rows behind ``(a1, a2, ...)`` in key order, for keyset paging; NULL is last."""
    cond = None
    for k, a in zip(reversed(keys), reversed(after)):
        c = F.col(k)
        behind = F.lit(False) if a is None else c.isNull() | (c > F.lit(a))
        cond = behind if cond is None else behind | (c.eqNullSafe(F.lit(a)) & cond)
    return cond


@dataclass(frozen=True)
class KeyRange:
    """Rows with given leading keys and the next key within bounds (None: open)."""

    rows: int
    fixed: tuple = ()
    low: object = None
    low_in: bool = True
    high: object = None
    high_in: bool = True
    nulls: bool = True

    def condition(self, df: DataFrame, keys: Sequence[str]) -> Column | None:
        parts = [F.col(k).isNull() if v is None else F.col(k) == _literal(df, k, v)
                 for k, v in zip(keys, self.fixed)]
        if len(self.fixed) < len(keys):
            key = keys[len(self.fixed)]
            c, within = F.col(key), []
            if self.low is not None:
                v = _literal(df, key, self.low)
                within.append(c >= v if self.low_in else c > v)
            if self.high is not None:
                v = _literal(df, key, self.high)
                within.append(c <= v if self.high_in else c < v)
            if not within and not self.nulls:
                within.append(c.isNotNull())
            if within:
                both = within[0] if len(within) == 1 else within[0] & within[1]
                parts.append(both | c.isNull() if self.nulls else both)
        cond = None
        for p in parts:
            cond = p if cond is None else cond & p
        return cond


def _literal(df: DataFrame, key: str, value) -> Column:
    return F.lit(value).cast(df.schema[key].dataType)


class KeyIndex:
    """Row counts of key ranges, refined where pages fall and kept for the next page.

    A level is one grouped count of the key column alone: every row finds its
    range among at most ``BOUNDS`` bounds by binary search, equal to a bound or
    between two of them, so that a key with many rows is a range of its own and
    is divided by the next key.  Bounds are approximate quantiles, or of a sample
    for text; the counts are exact.  The driver holds ``2 * BOUNDS + 2`` counts for each refined range.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], rows_at_once: int = ROWS_AT_ONCE,
                 bounds: int = BOUNDS):
        self.df, self.keys = df, list(keys)
        self.rows_at_once, self.bounds = rows_at_once, bounds
        self._divided: dict[KeyRange, list[KeyRange]] = {}
        self._first: tuple[KeyRange, list] | None = None

    @property
    def all(self) -> KeyRange:
        if self._first is None:
            rows, marks = self._quantiles(self.df.select(F.col(self.keys[0]).alias("k")))
            self._first = KeyRange(rows), marks
        return self._first[0]

    def _quantiles(self, values: DataFrame) -> tuple[int, list]:
        """The row count and, unless the key is text, approximate quantiles: one pass."""
        aggs = [F.count(F.lit(1)).alias("n")]
        kind = values.schema["k"].dataType
        if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            shares = F.array(*[F.lit((i + 0.5) / self.bounds) for i in range(self.bounds)])
            aggs.append(F.percentile_approx("k", shares, 20 * self.bounds).alias("marks"))
        found = values.agg(*aggs).first()
        return found["n"], list((found["marks"] if len(aggs) > 1 else None) or [])

    def _within(self, r: KeyRange) -> DataFrame:
        cond = r.condition(self.df, self.keys)
        return self.df if cond is None else self.df.where(cond)

    def _bounds(self, values: DataFrame, r: KeyRange) -> list:
        """Distinct values, ascending, that divide ``r``; at least one if a value isn't NULL."""
        marks = self._first[1] if r == self.all else self._quantiles(values)[1]
        if not marks:
            known = values.where(F.col("k").isNotNull())
            share = min(1.0, self.bounds * SAMPLED / max(1, r.rows))
            sample = [x["k"] for x in known.sample(share, seed=17).orderBy("k").collect()]
            step = max(1, len(sample) // self.bounds)
            marks = sample[step // 2::step]
            if not marks:
                least = known.agg(F.min("k")).first()[0]
                marks = [] if least is None else [least]
        return [v for i, v in enumerate(marks) if not i or v != marks[i - 1]]

    def divide(self, r: KeyRange) -> list[KeyRange]:
        """The parts of ``r`` in key order, those without rows left out."""
        if r in self._divided:
            return self._divided[r]
        values = self._within(r).select(F.col(self.keys[len(r.fixed)]).alias("k"))
        marks = self._bounds(values, r)
        key = self.keys[len(r.fixed)]

        def place(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(2 * lo)
            mid = (lo + hi) // 2
            v = _literal(self.df, key, marks[mid])
            return (F.when(F.col("k") < v, place(lo, mid)).when(F.col("k") == v, F.lit(2 * mid + 1))
                    .otherwise(place(mid + 1, hi)))

        last = 2 * len(marks) + 1
        at = F.when(F.col("k").isNull(), F.lit(last)).otherwise(place(0, len(marks)))
        counts = values.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
        parts = []
        for i, n in sorted((c["at"], c["n"]) for c in counts):
            if i == last or i % 2:
                parts.append(KeyRange(n, (*r.fixed, None if i == last else marks[i // 2])))
                continue
            j = i // 2
            part = replace(r, rows=n, nulls=False)
            if j > 0:
                part = replace(part, low=marks[j - 1], low_in=False)
            if j < len(marks):
                part = replace(part, high=marks[j], high_in=False)
            parts.append(part)
        self._divided[r] = parts
        return parts

    def _joined(self, parts: list[KeyRange], parent: KeyRange) -> KeyRange:
        """Neighbouring parts of ``parent`` as one range."""
        if len(parts) == 1:
            return parts[0]
        depth, out = len(parent.fixed), replace(parent, rows=sum(p.rows for p in parts), nulls=False)
        first, end = parts[0], parts[-1]
        if len(first.fixed) > depth:
            out = replace(out, low=first.fixed[depth], low_in=True)
        else:
            out = replace(out, low=first.low, low_in=first.low_in)
        if len(end.fixed) > depth and end.fixed[depth] is None:
            return replace(out, high=parent.high, high_in=parent.high_in, nulls=True)
        if len(end.fixed) > depth:
            return replace(out, high=end.fixed[depth], high_in=True)
        return replace(out, high=end.high, high_in=end.high_in)

    def pieces(self, r: KeyRange, offset: int, limit: int) -> list[tuple[KeyRange, int, int]]:
        """Small ranges that hold rows ``offset`` to ``offset + limit`` of ``r``: (range, offset, limit)."""
        limit = min(limit, r.rows - offset)
        if limit <= 0:
            return []
        if r.rows < self.rows_at_once or len(r.fixed) == len(self.keys):
            return [(r, offset, limit)]
        groups: list[tuple[int, list[KeyRange]]] = []
        start = 0
        for part in self.divide(r):
            if start < offset + limit and start + part.rows > offset:
                if groups and sum(p.rows for p in groups[-1][1]) + part.rows < self.rows_at_once:
                    groups[-1][1].append(part)
                else:
                    groups.append((start, [part]))
            start += part.rows
        out = []
        for begin, parts in groups:
            joined = self._joined(parts, r)
            low = max(offset - begin, 0)
            out += self.pieces(joined, low, min(offset + limit - begin, joined.rows) - low)
        return out

    def page(self, limit: int, offset: int) -> DataFrame:
        """``limit`` rows behind the first ``offset``, in key order."""
        found = self.pieces(self.all, offset, limit)
        order = _order(self.keys)
        out = None
        for r, skip, take in found:
            rows = self._within(r)
            if len(r.fixed) == len(self.keys):  # equal in every key: any of them
                rows = rows.limit(take)
            else:  # at most rows_at_once rows
                place = F.row_number().over(Window.orderBy(*order))
                rows = (rows.withColumn("__place", place - F.lit(skip))
                        .where(F.col("__place").between(1, take)).drop("__place"))
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return self.df.where(F.lit(False))
        return out.orderBy(*order)


def page(df: DataFrame, keys: Sequence[str], limit: int = DEFAULT_LIMIT, offset: int = 0,
         after: Sequence | None = None) -> DataFrame:
    """One page in key order.  ``keys`` must be unique (a total order)."""
    validate_page(limit, offset)
    if after is not None:
        df = df.where(after_key(keys, after))
    return page_deep(df, keys, limit, offset)


def page_deep(df: DataFrame, keys: Sequence[str], limit: int, offset: int) -> DataFrame:
    """A page of any size at any offset.  The counts run when it is called; for
    many pages of one table keep a ``KeyIndex`` instead."""
    return KeyIndex(df, keys).page(limit, offset)


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Deterministic TOP-n (O-05): sort on a total order, keep n rows."""
    return df.orderBy(*_order(order)).limit(n)


def lookup(df: DataFrame, key: Mapping[str, object]) -> DataFrame:
    """Point lookup (F-04); keys must be positive.  Empty result = not found."""
    for k, v in key.items():
        if v is None or (isinstance(v, (int, float)) and v <= 0):
            raise ValueError(f"{k} must be > 0, got {v!r}")
    cond = None
    for k, v in key.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df.where(cond)
