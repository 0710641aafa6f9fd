"""Numeric column functions with the rounding rules the metrics need.

All return ``Column`` expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.util import as_col


def dround(c, digits: int = 2) -> Column:
    """Round a double the way the reference SQL engine does.

    Scale by 10**digits, round half away from zero, scale back.  Bare
    ``F.round(x, 2)`` rounds the decimal text of ``x`` (1.005 -> 1.01) while the
    metrics expect the binary value (1.005 -> 1.0, 0.285 -> 0.28).
    """
    c = as_col(c).cast("double")
    if digits == 0:
        return F.round(c, 0)
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def to_int(c) -> Column:
    """Double -> int with half-to-even rounding (2.5 -> 2, 3.5 -> 4, 2.7 -> 3)."""
    return F.rint(as_col(c).cast("double")).cast("int")


def pct(part, whole, digits: int = 2) -> Column:
    """``part * 100.0 / whole`` as DOUBLE, rounded (never a DECIMAL)."""
    return dround(as_col(part).cast("double") * F.lit(100.0) / as_col(whole).cast("double"), digits)


def count_if(cond) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint (NULL cond -> 0)."""
    return F.sum(F.when(as_col(cond), F.lit(1)).otherwise(F.lit(0))).cast("long")


def rate(cond, digits: int = 2) -> Column:
    """Share of rows meeting ``cond`` in percent of ``COUNT(*)``."""
    return pct(count_if(cond), F.count(F.lit(1)), digits)


# Decimal places that sums behind averages keep exactly (a parameter of the
# functions below); the column functions of the metrics have at most two.
EXACT_SCALE = 4
# Largest value scaled to a whole number that a double holds exactly.
_WHOLE = 2.0 ** 53


def sum_parts(c, prefix: str, scale: int = EXACT_SCALE) -> list[Column]:
    """Partial sums behind ``sum_value``: exact, plain, values, exact values.

    A value that is a whole number of 10**-scale is added as a bigint, whose
    sum does not depend on the order of the rows; the plain sum covers what
    is not (more places, very large values, infinities, NaN).
    """
    v = as_col(c).cast("double")
    whole = F.rint(v * F.lit(10.0 ** scale))
    fits = (F.abs(whole) < F.lit(_WHOLE)) & (whole / F.lit(10.0 ** scale) == v)
    exact = F.when(fits, whole.cast("long"))
    return [F.try_sum(exact).alias(f"{prefix}_exact"), F.sum(v).alias(f"{prefix}_plain"),
            F.count(v).alias(f"{prefix}_n"), F.count(exact).alias(f"{prefix}_fit")]


def sum_value(exact, plain, n, fit, scale: int = EXACT_SCALE) -> Column:
    """The sum as DOUBLE: exact if every value was and no bigint overflowed."""
    e = as_col(exact)
    return F.when((as_col(n) == as_col(fit)) & e.isNotNull(),
                  e.cast("double") / F.lit(10.0 ** scale)).otherwise(as_col(plain))


def exact_avg(c, scale: int = EXACT_SCALE) -> Column:
    """AVG that does not depend on the order of the rows, as DOUBLE.

    A floating-point sum does depend on it, and an average that sits on a
    rounding tie (0.055 -> 0.05 or 0.06) then flips between runs and engines.
    Infinities and NaN come out as in plain AVG.
    """
    exact, plain, n, fit = (p for p in sum_parts(c, "p", scale))
    return sum_value(exact, plain, n, fit, scale) / n.cast("double")


def square_parts(c, prefix: str, scale: int = EXACT_SCALE) -> list[Column]:
    """Partial sums of squares beside ``sum_parts``: exact (a decimal) and plain.

    The square of a whole number of 10**-scale below 3e9 fits a bigint; the sum
    of such squares is a decimal and does not depend on the order of the rows.
    """
    v = as_col(c).cast("double")
    whole = F.rint(v * F.lit(10.0 ** scale))
    fits = (F.abs(whole) < F.lit(3.0e9)) & (whole / F.lit(10.0 ** scale) == v)
    w = F.when(fits, whole.cast("long"))
    return [F.try_sum((w * w).cast("decimal(19,0)")).alias(f"{prefix}_squares"),
            F.sum(v * v).alias(f"{prefix}_plain_squares"), F.count(w).alias(f"{prefix}_square_fit")]


def sample_stddev(exact, plain, n, fit, squares, plain_squares, square_fit,
                  scale: int = EXACT_SCALE) -> Column:
    """Sample standard deviation from ``sum_parts`` and ``square_parts``, as DOUBLE.

    ``n * sum of squares - square of sum`` is worked out in decimals if all
    values were exact and it fits, else in doubles.  NULL for fewer than two values.
    """
    k = as_col(n)
    s = as_col(exact).cast("decimal(19,0)")
    spread = F.try_subtract(F.try_multiply(k.try_cast("decimal(12,0)"), as_col(squares).try_cast("decimal(25,0)")),
                            F.try_multiply(s, s))
    all_exact = (k == as_col(fit)) & (k == as_col(square_fit)) & spread.isNotNull()
    pairs = k.cast("double") * (k - F.lit(1)).cast("double")
    rough = F.greatest(F.lit(0.0), k.cast("double") * as_col(plain_squares) - as_col(plain) * as_col(plain))
    rough = F.when(F.isnan(as_col(plain_squares)) | F.isnan(as_col(plain)), F.lit(float("nan"))).otherwise(rough)
    var = F.when(all_exact, spread.cast("double") / F.lit(10.0 ** (2 * scale))).otherwise(rough) / pairs
    return F.when(k > 1, F.sqrt(var))


def exact_stddev(c, scale: int = EXACT_SCALE) -> Column:
    """STDDEV_SAMP that does not depend on the order of the rows, where values are
    whole numbers of 10**-scale; others use the engine's own."""
    exact, _, n, fit = sum_parts(c, "p", scale)
    squares, _, square_fit = square_parts(c, "p", scale)
    null = F.lit(None).cast("double")
    return F.coalesce(
        F.when((n == fit) & (n == square_fit), sample_stddev(exact, null, n, fit, squares, null, square_fit, scale)),
        F.stddev_samp(as_col(c)))


def ravg(c, digits: int = 2) -> Column:
    """Rounded exact average of a column (NULL for no non-NULL value)."""
    return dround(exact_avg(c), digits)


def clamp(c, lo: float, hi: float) -> Column:
    """``LEAST(hi, GREATEST(lo, c))``; NULL is skipped by both."""
    return F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), as_col(c)))
