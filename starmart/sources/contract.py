"""Source contract checks before ingest (S-01, S-02, S-11).

A report is a DataFrame with one row per check::

    table_name, check_name, severity, observed, expected, passed

``severity`` is ``error`` (blocks the run) or ``warning`` (logged only).
Row counts are computed by Spark; the few metadata facts (file exists, size,
header) come from the file system and the header line.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import file_size, path_exists
from starmart.specs import TableSpec

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("observed", T.LongType(), True),
    T.StructField("expected", T.LongType(), True),
    T.StructField("passed", T.BooleanType(), False),
])


class ContractError(RuntimeError):
    """Raised when an error-severity check failed."""


def _row(table, check, severity, observed, expected, passed):
    return (table, check, severity, None if observed is None else int(observed),
            None if expected is None else int(expected), bool(passed))


def csv_contract(spark: SparkSession, path: str, spec: TableSpec,
                 count_rows: bool = True) -> DataFrame:
    """Contract of one CSV file: exists, not empty, header, columns, PII, rows.

    ``count_rows=False`` checks metadata only (no pass over the data); the
    row-count checks are then taken from the ingest pass (``rows_report``).
    """
    from starmart.sources.csv import clean_name, header_columns, read_csv_raw
    name = spec.name
    rows = []
    if not path_exists(spark, path):
        rows.append(_row(name, "file_exists", "error", 0, 1, False))
        return spark.createDataFrame(rows, REPORT_SCHEMA)
    rows.append(_row(name, "file_exists", "error", 1, 1, True))
    size = file_size(spark, path)
    rows.append(_row(name, "file_not_empty", "error", size, 1, size > 0))
    if size == 0:
        return spark.createDataFrame(rows, REPORT_SCHEMA)
    header = [clean_name(c) for c in header_columns(spark, path)]
    rows.append(_row(name, "header_present", "error", len(header), 1, len(header) > 0))
    missing = [c for c in spec.columns if c not in header]
    rows.append(_row(name, "required_columns", "error", len(spec.columns) - len(missing),
                     len(spec.columns), not missing))
    pii_missing = [c for c in spec.pii if c not in header]
    rows.append(_row(name, "pii_columns_present", "error", len(spec.pii) - len(pii_missing),
                     len(spec.pii), not pii_missing))
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if not count_rows:
        return report
    counted = row_count_checks(read_csv_raw(spark, path, spec), name, spec.min_rows,
                               spec.expected_rows)
    return report.unionByName(counted)


def rows_report(spark: SparkSession, counts: Mapping[str, int],
                specs: Mapping[str, TableSpec]) -> DataFrame:
    """``min_rows`` / parity checks from row counts already observed (no data pass)."""
    rows = []
    for name, n in counts.items():
        spec = specs[name]
        rows.append(_row(name, "min_rows", "error", n, spec.min_rows, n >= spec.min_rows))
        if spec.expected_rows is not None:
            rows.append(_row(name, "row_count_parity", "warning", n, spec.expected_rows,
                             n == spec.expected_rows))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def row_count_checks(df: DataFrame, table: str, min_rows: int = 1,
                     expected_rows: int | None = None) -> DataFrame:
    """``min_rows`` (error) and expected-count parity (warning), one Spark job."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    checks = [n.select(F.lit(table).alias("table_name"), F.lit("min_rows").alias("check_name"),
                       F.lit("error").alias("severity"), F.col("n").alias("observed"),
                       F.lit(int(min_rows)).cast("long").alias("expected"),
                       (F.col("n") >= F.lit(int(min_rows))).alias("passed"))]
    if expected_rows is not None:
        checks.append(n.select(
            F.lit(table).alias("table_name"), F.lit("row_count_parity").alias("check_name"),
            F.lit("warning").alias("severity"), F.col("n").alias("observed"),
            F.lit(int(expected_rows)).cast("long").alias("expected"),
            (F.col("n") == F.lit(int(expected_rows))).alias("passed")))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def table_contract(df: DataFrame, table: str, declared: T.StructType,
                   min_rows: int = 1, expected_rows: int | None = None) -> DataFrame:
    """Contract of an already readable table (e.g. Parquet): columns + rows."""
    spark = df.sparkSession
    present = set(df.columns)
    names = [f.name for f in declared.fields]
    n_present = sum(1 for c in names if c in present)
    cols = spark.createDataFrame(
        [_row(table, "required_columns", "error", n_present, len(names),
              n_present == len(names))], REPORT_SCHEMA)
    return cols.unionByName(row_count_checks(df, table, min_rows, expected_rows))


def contract_all(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Union of per-table reports (S-02)."""
    items = list(reports.values())
    out = items[0]
    for r in items[1:]:
        out = out.unionByName(r)
    return out


def enforce(report: DataFrame) -> DataFrame:
    """Raise ``ContractError`` if any error-severity check failed.

    Only the failing rows (at most a handful per table) reach the driver.
    """
    failed = report.where((F.col("severity") == "error") & ~F.col("passed")).collect()
    if failed:
        lines = ", ".join(f"{r.table_name}.{r.check_name} ({r.observed} vs {r.expected})"
                          for r in failed)
        raise ContractError(f"contract failed: {lines}")
    return report
