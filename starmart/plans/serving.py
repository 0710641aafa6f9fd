"""Read queries behind the serving routes (V-01 ... V-08) and the serving sink.

The HTTP layer is not rebuilt; each route is a function returning a
DataFrame (the caller collects a page, never a whole table).  Equality
filters reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.metrics import reaggregate
from starmart.operators.paging import DEFAULT_LIMIT, apply_filters, lookup, page, top_n
from starmart.plans.models import METRIC_ORDER, sort_columns
from starmart.sources.layers import bools_to_int, replace_parquet
from starmart.functions.text import mask_prefix

# The fields of a published student record behind its key column(s).
RECORD_FIELDS = (
    "student_key", "national_id_hashed", "gender", "age_derived",
    "health_condition", "severity_level", "treatment_type",
    "bmi", "bmi_class", "heart_rate", "sleep_duration", "sleep_adequate",
    "sleep_quality", "step_count", "exercise_duration", "calorie_expenditure",
    "water_intake", "hydration_adequate", "stress_level",
    "physical_activity_level", "activity_type", "diet_type", "smoking_alcohol",
    "composite_activity_score", "health_trend_indicator",
)


def record_columns(key_cols: Sequence[str]):
    return [*key_cols, *RECORD_FIELDS, F.col("full_date").cast("string").alias("full_date")]


def list_students(fact: DataFrame, *, health_condition=None, gender=None, bmi_class=None,
                  diet_type=None, limit: int = DEFAULT_LIMIT, offset: int = 0,
                  key_cols: Sequence[str] = ("fact_id",), after=None,
                  tie_break: bool = False) -> DataFrame:
    """V-01: filtered page of records ordered by the fact key.

    A page needs a total order.  ``tie_break`` extends the order by every
    other record column, for keys that are not unique; rows equal in all
    columns are identical, so the page is then fully determined.  Keyset
    paging (``after``) takes values for ``key_cols`` only.
    """
    f = apply_filters(fact, {"health_condition": health_condition, "gender": gender,
                             "bmi_class": bmi_class, "diet_type": diet_type})
    records = f.select(*record_columns(key_cols))
    order = list(key_cols)
    if tie_break and after is None:
        order += [c for c in records.columns if c not in key_cols]
    return page(records, order, limit, offset, after)


def get_student(fact: DataFrame, key: Mapping[str, object] | int,
                key_cols: Sequence[str] = ("fact_id",)) -> DataFrame:
    """V-02: one record by key; an empty result means not found."""
    if not isinstance(key, Mapping):
        key = {key_cols[0]: key}
    return lookup(fact, key).select(*record_columns(key_cols))


def _metric(metric: DataFrame, filters: Mapping[str, object], order) -> DataFrame:
    return apply_filters(metric, filters).orderBy(*order)


def health_distribution(metric: DataFrame, health_condition=None, gender=None,
                        diet_type=None) -> DataFrame:
    """V-03: by record count, descending (ties broken by the group keys)."""
    return _metric(metric, {"health_condition": health_condition, "gender": gender,
                            "diet_type": diet_type},
                   [F.desc_nulls_last("record_count"),
                    *sort_columns(METRIC_ORDER["mrt_health_distribution"])])


def class_balance(metric: DataFrame) -> DataFrame:
    """V-04: per condition, total records and the sum of rounded shares."""
    return reaggregate(metric, ["health_condition"], {"total_records": "record_count"},
                       {"pct_of_total": ("pct_of_total", 2)}) \
        .orderBy(F.desc_nulls_last("total_records"), F.asc_nulls_last("health_condition"))


def bmi_by_gender(metric: DataFrame, gender=None, health_condition=None,
                  bmi_class=None) -> DataFrame:
    """V-05."""
    return _metric(metric, {"gender": gender, "health_condition": health_condition,
                            "bmi_class": bmi_class},
                   [F.asc_nulls_last("health_condition"), F.asc_nulls_last("bmi_class"),
                    F.asc_nulls_last("gender")])


def risk_correlations(metric: DataFrame, health_condition=None, physical_activity_level=None,
                      smoking_alcohol=None) -> DataFrame:
    """V-06."""
    return _metric(metric, {"health_condition": health_condition,
                            "physical_activity_level": physical_activity_level,
                            "smoking_alcohol": smoking_alcohol},
                   [F.desc_nulls_last("record_count"),
                    *[F.asc_nulls_last(c) for c in ("health_condition",
                                                    "physical_activity_level",
                                                    "smoking_alcohol", "diet_type",
                                                    "sleep_quality", "activity_type")]])


def sleep_adequacy(metric: DataFrame, health_condition=None) -> DataFrame:
    """V-07."""
    return _metric(metric, {"health_condition": health_condition},
                   [F.asc_nulls_last("health_condition"), F.asc_nulls_last("sleep_quality"),
                    F.desc_nulls_last("sleep_adequate")])


def weekly_activity(metric: DataFrame, health_condition=None, year=None,
                    month=None) -> DataFrame:
    """V-08."""
    return _metric(metric, {"health_condition": health_condition, "year": year,
                            "month": month},
                   sort_columns(METRIC_ORDER["mrt_weekly_activity"]))


# ---------------------------------------------------------------- promotion (S-16, S-17)


def promote(df: DataFrame, *, path: str | None = None, table: str | None = None,
            jdbc_url: str | None = None, jdbc_table: str | None = None,
            jdbc_props: Mapping[str, str] | None = None, batchsize: int = 2000) -> DataFrame:
    """Publish a table to the serving store, flags as 0/1 ints, replacing it.

    Executors write directly (no whole-table copy through the driver).  Use
    ``batchsize=1000`` for metric tables as the reference does.
    """
    out = bools_to_int(df)
    if path is not None:
        replace_parquet(out, path)
    if table is not None:
        out.write.mode("overwrite").saveAsTable(table)
    if jdbc_url is not None:
        props = dict(jdbc_props or {})
        props.setdefault("batchsize", str(batchsize))
        out.write.mode("overwrite").jdbc(jdbc_url, jdbc_table, properties=props)
    return out


def verify_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """S-18: row count per serving table; a missing table is reported, not raised."""
    from starmart.sources.layers import table_counts
    present = {k: v for k, v in tables.items() if v is not None}
    rows = table_counts(present).withColumn("present", F.lit(True))
    missing = [k for k, v in tables.items() if v is None]
    if missing:
        rows = rows.unionByName(spark.createDataFrame(
            [(m, None, False) for m in missing],
            "table_name string, row_count bigint, present boolean"))
    return rows


def sample_students(dim: DataFrame, n: int = 3, order: Sequence[str] = ("student_key",)) -> DataFrame:
    """S-19: first ``n`` students with the hash shown as its first 8 characters."""
    return top_n(dim.select(*order, mask_prefix("national_id_hashed").alias("hash_prefix"),
                            "gender", "age_derived"), list(order), n)
