"""CSV extracts -> typed DataFrames (S-03, S-04, T2-01).

Every column is read as text with the file's own header order, missing-value
tokens become NULL, then each column is coerced to its declared type.  A
value that does not convert becomes NULL and is counted, never silently
kept.  Malformed lines (too few or too many fields) can be split off into a
quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import NA_TOKENS, na_to_null
from starmart.functions.util import as_col
from starmart.specs import TableSpec

CORRUPT_COL = "_corrupt_record"


# Quotes inside quoted text are doubled; a backslash is an ordinary character.
# Blanks around a value are part of it.
DIALECT = {"header": True, "quote": '"', "escape": '"',
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def header_columns(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """Column names exactly as written in the file's header."""
    return (spark.read.options(**DIALECT).option("multiLine", multiline)
            .option("inferSchema", False).csv(path).columns)


def clean_name(column: str) -> str:
    """A header's column name without byte order mark and blanks."""
    return column.lstrip("﻿").strip()


def read_csv_raw(spark: SparkSession, path: str, spec: TableSpec | None = None, *,
                 multiline: bool = False, quarantine: bool = False,
                 na_tokens=NA_TOKENS) -> DataFrame:
    """All columns as strings, in the spec's order, NA tokens mapped to NULL.

    Columns are matched by header *name*; a folder whose files have different
    headers raises.  A declared column missing from the file comes back as
    NULL (the contract check reports it).  ``multiline``
    allows quoted newlines but makes each file a single split; keep it off
    unless a table needs it.  ``quarantine`` keeps the raw text of malformed
    lines in ``_corrupt_record``.
    """
    written = header_columns(spark, path, multiline)
    by_name = {clean_name(c): c for c in written}
    fields = [T.StructField(c, T.StringType(), True) for c in written]
    if quarantine:
        fields.append(T.StructField(CORRUPT_COL, T.StringType(), True))
    reader = (spark.read.schema(T.StructType(fields))
              .options(**DIALECT).option("enforceSchema", False)
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if quarantine:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    df = reader.csv(path)
    wanted = spec.columns if spec is not None else list(by_name)
    out = [na_to_null(F.col(f"`{by_name[c]}`"), na_tokens).alias(c) if c in by_name
           else F.lit(None).cast("string").alias(c) for c in wanted]
    if quarantine:
        out.append(F.col(CORRUPT_COL))
    return df.select(*out)


def write_csv_extract(df: DataFrame, path: str) -> None:
    """Write ``df`` as a headed CSV extract (one file per task, overwrite).

    A round trip through ``read_csv_raw`` returns the text as it was (with
    ``multiline`` where it holds line breaks), empty text as NULL.
    """
    df.write.mode("overwrite").options(**DIALECT).csv(path)


# Text that pandas' numeric parser rejects but a Java double parse accepts:
# a trailing type suffix such as "5d" or "1f".
_JAVA_SUFFIX = r"(?i)[0-9.][df]\s*$"


def to_double(c) -> Column:
    """Lenient text -> double: ' 7 ' -> 7.0, '1e3' -> 1000.0, 'abc' -> NULL.

    A number too large for a double ('1e400') is NULL, as in the reference's
    parser; only a spelled-out infinity ('inf', '-Infinity') stays infinite.
    """
    v = as_col(c)
    d = v.try_cast("double")
    overflow = (F.abs(d) == F.lit(float("inf"))) & ~v.rlike(r"(?i)inf")
    return F.when(~v.rlike(_JAVA_SUFFIX) & ~overflow, F.nanvl(d, F.lit(None).cast("double")))


def to_whole(c, target: str = "long") -> Column:
    """Lenient text -> integer type; a fractional or out-of-range value is NULL.

    Plain digits are read as they are, so every value of the type survives;
    other spellings of a whole number ('7.0', '1e3') go through a decimal.
    """
    v = F.trim(as_col(c))
    d = to_double(c)
    spelt = F.when(F.rint(d) == d, v.try_cast(T.DecimalType(38, 9)).try_cast(target))
    return F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast(target)).otherwise(spelt)


def coerce_column(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.LongType):
        return to_whole(c, "long")
    if isinstance(dtype, T.IntegerType):
        return to_whole(c, "int")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return to_double(c).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.col(c)
    return F.col(c).try_cast(dtype)


def coerce(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed projection of a raw string table (S-04)."""
    return raw.select(*[coerce_column(c, t).alias(c) for c, t in spec.types])


def cast_failure_metrics(spec: TableSpec) -> list[Column]:
    """Per column: rows with text that did not convert (aggregate expressions)."""
    out = []
    for c, t in spec.types:
        if isinstance(t, T.StringType):
            continue
        failed = F.col(c).isNotNull() & coerce_column(c, t).isNull()
        out.append(F.sum(F.when(failed, 1).otherwise(0)).cast("long").alias(f"cast_fail__{c}"))
    return out


def split_quarantine(raw: DataFrame, bronze_path: str) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed lines with their raw text); see ``land_quarantine``."""
    good, bad, _ = land_quarantine(raw, bronze_path)
    return good, bad


def land_quarantine(raw: DataFrame, bronze_path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Well-formed rows, malformed lines with their raw text, and how many there are of both.

    Spark's CSV reader only tokenises the columns a query needs, so the
    field-count check behind ``_corrupt_record`` is reliable only when every
    column is parsed.  The full parse is therefore landed once as a bronze
    Parquet table (one CSV pass, lineage cut); both sides are read from it.  The
    counts are observed on that write.  A quote left open swallows the fields
    behind it; in the last field it can't be told from text that begins with one.
    """
    cols = [c for c in raw.columns if c != CORRUPT_COL]
    seen = Observation()
    corrupt = F.col(CORRUPT_COL).isNotNull()
    raw.withColumn("source_file", F.input_file_name()) \
        .observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(corrupt).alias("malformed")) \
        .write.mode("overwrite").parquet(bronze_path)
    bronze = raw.sparkSession.read.parquet(bronze_path)
    good = bronze.where(F.col(CORRUPT_COL).isNull()).select(*cols)
    bad = bronze.where(F.col(CORRUPT_COL).isNotNull()).select(
        F.col(CORRUPT_COL).alias("raw_line"), "source_file", *cols)
    return good, bad, {k: int(v or 0) for k, v in seen.get.items()}
