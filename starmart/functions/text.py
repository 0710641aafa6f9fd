"""Text cleaning functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.util import as_col

# The tokens the ingest treats as missing (exact match, no trim).
# "NA" and "n/a" are deliberately not in the list and stay text.
NA_TOKENS = ("", "NULL", "null", "None", "NaN")

# The Unicode "space separator" (Zs) characters, stripped at
# either end by TRIM.  Tabs and line breaks are not in the class and are kept.
SPACE_SEPARATORS = ("\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                    "\u2007\u2008\u2009\u200a\u202f\u205f\u3000")


def clean(c) -> Column:
    """TRIM that strips Unicode space separators but keeps tabs.

    Spark's set-based ``btrim`` (no regular expression per row).
    """
    return F.btrim(as_col(c), F.lit(SPACE_SEPARATORS))


def clean_lower(c) -> Column:
    return F.lower(clean(c))


def clean_upper(c) -> Column:
    return F.upper(clean(c))


def na_to_null(c, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Map the missing-value tokens to NULL, leave other text unchanged."""
    c = as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def mask_prefix(c, n: int = 8) -> Column:
    """First ``n`` characters (used to show hashes in samples)."""
    return F.substring(as_col(c), 1, n)
