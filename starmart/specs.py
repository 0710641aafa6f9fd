"""Declared table contracts: schemas, required columns, PII, domains, tests.

One ``TableSpec`` per source table holds everything the ingest, the profile
and the checks need, so the schema is declared once and nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
F32, TS = T.FloatType(), T.TimestampNTZType()


def struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class TableSpec:
    """Contract of one source table.

    ``types``: ingest type per column, in file order; ``required``: columns
    whose NULLs are counted at ingest; ``pii``: columns that must be present
    at the source and absent from published tables; ``dedup``: column whose
    duplicate count is reported; ``domains``: accepted values (staged, lower
    case unless noted); ``ranges``: inclusive numeric bounds.
    """

    name: str
    types: tuple[tuple[str, T.DataType], ...]
    required: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()
    dedup: str | None = None
    key: str | None = None
    min_rows: int = 1
    expected_rows: int | None = None
    domains: dict = field(default_factory=dict)
    ranges: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.types]

    @property
    def schema(self) -> T.StructType:
        return struct(*self.types)

    @property
    def string_schema(self) -> T.StructType:
        return struct(*[(c, S) for c, _ in self.types])


# ---------------------------------------------------------------- health star (fixed values)

EXPECTED_ROWS = 49_998

HEALTH_SPECS: dict[str, TableSpec] = {
    "dim_student": TableSpec(
        "dim_student",
        (("student_key", L), ("National_ID", S), ("First_Name", S), ("Last_Name", S),
         ("Gender", S), ("Age", D), ("Date_of_birth", S), ("Start_date", S), ("End_date", S),
         ("Is_current", S)),
        required=("student_key", "National_ID"),
        pii=("National_ID", "First_Name", "Last_Name", "Date_of_birth"),
        dedup="National_ID", key="student_key", expected_rows=EXPECTED_ROWS,
        domains={"gender": ("male", "female", "other"), "is_current": ("YES", "NO")}),
    "dim_health": TableSpec(
        "dim_health",
        (("health_key", L), ("Health_Condition", S), ("Typical_Severity_Level", S),
         ("General_Treatment_Type", S)),
        required=("health_key", "Health_Condition"), key="health_key",
        expected_rows=EXPECTED_ROWS,
        domains={"health_condition": ("fit", "at-risk", "unhealthy"),
                 "severity_level": ("low", "medium", "high")}),
    "dim_lifestyle": TableSpec(
        "dim_lifestyle",
        (("lifestyle_key", L), ("Diet_Type", S), ("Smoking_Alcohol", S),
         ("Physical_Activity_Level", S)),
        required=("lifestyle_key",), key="lifestyle_key", expected_rows=EXPECTED_ROWS,
        domains={"diet_type": ("veg", "non-veg", "balanced"),
                 "smoking_alcohol": ("no", "occasional", "yes"),
                 "physical_activity_level": ("sedentary", "moderate", "active")}),
    "dim_activity": TableSpec(
        "dim_activity", (("activity_key", L), ("Activity_Type", S)),
        required=("activity_key", "Activity_Type"), key="activity_key",
        expected_rows=EXPECTED_ROWS),
    "dim_sleep": TableSpec(
        "dim_sleep", (("sleep_key", L), ("Sleep_Quality", S)),
        required=("sleep_key",), key="sleep_key", expected_rows=EXPECTED_ROWS,
        domains={"sleep_quality": ("poor", "average", "good")}),
    "dim_date": TableSpec(
        "dim_date",
        (("date_key", L), ("full_date", S), ("day_of_week", S), ("month", L), ("year", L)),
        required=("date_key", "full_date"), key="date_key", expected_rows=EXPECTED_ROWS,
        ranges={"month": (1, 12)}),
    "fact_health_analytics": TableSpec(
        "fact_health_analytics",
        (("fact_id", L), ("student_key", L), ("lifestyle_key", L), ("health_key", L),
         ("activity_key", L), ("sleep_key", L), ("date_key", L), ("bmi", D),
         ("heart_rate", D), ("stress_level", D), ("sleep_duration", D), ("step_count", D),
         ("exercise_duration", D), ("calorie_expenditure", D), ("water_intake", D)),
        required=("fact_id", "student_key", "lifestyle_key", "health_key", "activity_key",
                  "sleep_key", "date_key", "bmi", "heart_rate", "stress_level",
                  "sleep_duration"),
        key="fact_id", expected_rows=EXPECTED_ROWS,
        ranges={"bmi": (16.0, 35.0), "heart_rate": (50, 120), "sleep_duration": (3.0, 10.0),
                "step_count": (1000, 14999), "exercise_duration": (0, 120),
                "calorie_expenditure": (1200, 3901), "water_intake": (0.5, 4.94)}),
}

# Source file name of each table (upper case, .csv).
HEALTH_FILES = {name: f"{name.upper()}.csv" for name in HEALTH_SPECS}

# Declared column tests per model, (unique columns, not-null columns).
MODEL_TESTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "stg_student": (("student_key",), ("student_key", "national_id", "gender", "is_current")),
    "stg_health": (("health_key",), ("health_key", "health_condition", "severity_level")),
    "stg_lifestyle": (("lifestyle_key",), ("lifestyle_key", "diet_type", "smoking_alcohol",
                                          "physical_activity_level")),
    "stg_activity": (("activity_key",), ("activity_key", "activity_type")),
    "stg_sleep": (("sleep_key",), ("sleep_key", "sleep_quality")),
    "stg_date": (("date_key",), ("date_key", "month", "year")),
    "stg_fact": (("fact_id",), ("fact_id", "student_key", "health_key", "lifestyle_key",
                                "activity_key", "sleep_key", "date_key", "bmi", "heart_rate",
                                "stress_level", "sleep_duration")),
    "int_student_features": (("student_key",), ("student_key", "national_id_hashed",
                                                "first_name", "gender", "age_derived")),
    "int_fact_enriched": (("fact_id",), ("fact_id", "health_condition", "bmi_class",
                                         "health_trend_indicator", "composite_activity_score")),
    "dim_student_transformed": (("student_key",), ("student_key", "national_id_hashed",
                                                   "gender", "age_derived")),
    "fact_health_transformed": (("fact_id",), ("fact_id", "health_condition", "bmi_class",
                                               "health_trend_indicator",
                                               "composite_activity_score", "bmi",
                                               "heart_rate")),
    "mrt_health_distribution": ((), ("record_count",)),
}

# ---------------------------------------------------------------- driver tables

DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                       ("c_mktsegment", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                   ("p_size", I), ("p_retailprice", D)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                     ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                       ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                       ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                       ("l_linestatus", S), ("l_shipdate", TS)),
    "events": struct(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                     ("value", D), ("props", S)),
    "documents": struct(("doc_id", L), ("text", S), ("lang", S), ("source", S),
                        ("n_chars", L)),
    "embeddings": struct(("vec_id", L), ("element", F32), ("label", I)),
    "pages": struct(("page_id", L), ("url", S), ("html", S)),
    "benchmark": struct(("item_id", L), ("text", S)),
    "labels": struct(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": struct(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}
