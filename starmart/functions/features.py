"""Feature-engineering column functions (bands, flags, scores, encodings).

Each takes column names and parameters so the same code serves any star.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.dates import as_of_date, year_diff
from starmart.functions.numeric import clamp, dround, to_int
from starmart.functions.util import as_col

# The parameters of the reference's health features.
BMI_BANDS = ((18.5, "Underweight"), (25.0, "Normal"), (30.0, "Overweight"))
BMI_ELSE = "Obese"
SLEEP_ADEQUATE_HOURS = 7.0
HYDRATION_ADEQUATE_LITRES = 2.0
# (input, low, high, weight): steps 1,000-14,999 w40; minutes 0-120 w35;
# calories 1,200-3,901 w25.
ACTIVITY_SCORE_PARTS = (
    ("step_count", 1000.0, 14999.0, 40.0),
    ("exercise_duration", 0.0, 120.0, 35.0),
    ("calorie_expenditure", 1200.0, 3901.0, 25.0),
)
TREND_BANDS = ((65.0, "improving"), (35.0, "stable"))
TREND_ELSE = "declining"
SLEEP_QUALITY_ORDER = {"poor": 1, "average": 2, "good": 3}
ACTIVITY_LEVEL_ORDER = {"sedentary": 1, "moderate": 2, "active": 3}
SMOKING_ALCOHOL_ORDER = {"no": 1, "occasional": 2, "yes": 3}
DIET_VALUES = (("veg", "diet_veg"), ("non-veg", "diet_non_veg"), ("balanced", "diet_balanced"))
GENDER_VALUES = (("male", "gender_male"), ("female", "gender_female"), ("other", "gender_other"))
MASKED_NAME = "PSEUDONYMISED"


def band(c, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Threshold banding ``c < cut1 -> l1, c < cut2 -> l2, ... else otherwise``.

    The value is compared as DOUBLE; a NULL value falls through to
    ``otherwise`` (a NULL BMI is 'Obese', as in the reference).
    """
    v = as_col(c).cast("double")
    expr = None
    for cut, label in cuts:
        cond = v < F.lit(float(cut))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def band_ge(c, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Descending banding ``c >= cut1 -> l1, c >= cut2 -> l2, ... else``."""
    v = as_col(c)
    expr = None
    for cut, label in cuts:
        cond = v >= F.lit(float(cut))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def flag_ge(c, threshold: float) -> Column:
    """Boolean ``c >= threshold`` that is FALSE (never NULL) for a NULL value."""
    return F.when(as_col(c) >= F.lit(float(threshold)), F.lit(True)).otherwise(F.lit(False))


def weighted_score(parts: Sequence[tuple], lo: float = 0.0, hi: float = 100.0,
                   digits: int = 2) -> Column:
    """Weighted min-max score: sum of coalesce((x-lo)/(hi-lo)*w, 0), clamped.

    Parts are not clamped one by one, only the total; a NULL input adds 0.
    ``parts`` holds ``(column, low, high, weight)``.
    """
    total = None
    for c, p_lo, p_hi, w in parts:
        term = F.coalesce(
            (as_col(c).cast("double") - F.lit(float(p_lo)))
            / F.lit(float(p_hi) - float(p_lo)) * F.lit(float(w)),
            F.lit(0.0))
        total = term if total is None else total + term
    return dround(clamp(total, lo, hi), digits)


def ordinal(c, order: Mapping[str, int]) -> Column:
    """Ordinal code of a category; an unknown or NULL value gives NULL."""
    v = as_col(c)
    expr = None
    for value, code in order.items():
        cond = v == F.lit(value)
        expr = F.when(cond, F.lit(int(code))) if expr is None else expr.when(cond, F.lit(int(code)))
    return expr


def one_hot(c, values: Sequence[tuple[str, str]]) -> list[Column]:
    """One 0/1 int column per ``(value, output_name)``; unknown/NULL -> all 0."""
    v = as_col(c)
    return [F.when(v == F.lit(value), F.lit(1)).otherwise(F.lit(0)).alias(name)
            for value, name in values]


def pseudonymise(c, method: str = "md5", salt: str | None = None) -> Column:
    """Hash an identifier: lower-hex MD5 of its text (NULL stays NULL).

    ``method='sha256'`` with a secret ``salt`` is the stronger option.
    """
    v = as_col(c).cast("string")
    if method == "md5":
        return F.md5(v if salt is None else F.concat(F.lit(salt), v))
    if method == "sha256":
        return F.sha2(v if salt is None else F.concat(F.lit(salt), v), 256)
    raise ValueError(f"unknown pseudonymisation method {method!r}")


def age_years(birth_date, fallback_age, as_of=None) -> Column:
    """Age as calendar-year difference to ``as_of``; else the rounded source age."""
    b = as_col(birth_date)
    return (F.when(b.isNotNull(), year_diff(b, as_of_date(as_of)).cast("int"))
            .otherwise(to_int(fallback_age)))
