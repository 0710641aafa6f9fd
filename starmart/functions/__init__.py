"""Column-returning functions (Spark built-ins only, no Python UDFs)."""

from starmart.functions.dates import (as_of_date, to_date, try_date, week_of_month,
                                      week_start, year_diff)
from starmart.functions.features import (age_years, band, band_ge, flag_ge, one_hot,
                                         ordinal, pseudonymise, weighted_score)
from starmart.functions.numeric import (clamp, count_if, dround, pct, ravg, rate, to_int)
from starmart.functions.text import clean, clean_lower, clean_upper, mask_prefix, na_to_null

__all__ = [
    "as_of_date", "to_date", "try_date", "week_of_month", "week_start", "year_diff",
    "age_years", "band", "band_ge", "flag_ge", "one_hot", "ordinal", "pseudonymise",
    "weighted_score", "clamp", "count_if", "dround", "pct", "ravg", "rate", "to_int",
    "clean", "clean_lower", "clean_upper", "mask_prefix", "na_to_null",
]
