"""The star-schema models: staging, intermediate, marts and metrics.

Each model is a function ``DataFrames -> DataFrame``; nothing is executed
until a writer or an action runs.  Column names are those of the health star
(``health_condition``, ``bmi``, ...); other stars are bound to them by a
staging projection (see ``plans.driver``), so the same model code runs there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.specs import HEALTH_SPECS
from starmart.functions import features as feat
from starmart.functions.dates import try_date, week_of_month
from starmart.functions.numeric import count_if, dround, exact_stddev, rate, ravg, to_int
from starmart.functions.text import clean, clean_lower, clean_upper
from starmart.operators.metrics import grouped_metrics, reaggregate
from starmart.operators.star import Dim, star_join

# ---------------------------------------------------------------- staging (P-01 ... P-07)


def stage_student(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("student_key").cast("long").alias("student_key"),
        F.col("National_ID").cast("string").alias("national_id"),
        clean("First_Name").alias("first_name"),
        clean("Last_Name").alias("last_name"),
        clean_lower("Gender").alias("gender"),
        F.col("Age").cast("double").alias("age_raw"),
        try_date("Date_of_birth").alias("date_of_birth"),
        try_date("Start_date").alias("start_date"),
        try_date("End_date").alias("end_date"),
        clean_upper("Is_current").alias("is_current"),
    )


def stage_health(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("health_key").cast("long").alias("health_key"),
        clean_lower("Health_Condition").alias("health_condition"),
        clean_lower("Typical_Severity_Level").alias("severity_level"),
        clean("General_Treatment_Type").alias("treatment_type"),
    )


def stage_lifestyle(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("lifestyle_key").cast("long").alias("lifestyle_key"),
        clean_lower("Diet_Type").alias("diet_type"),
        clean_lower("Smoking_Alcohol").alias("smoking_alcohol"),
        clean_lower("Physical_Activity_Level").alias("physical_activity_level"),
    )


def stage_activity(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("activity_key").cast("long").alias("activity_key"),
        clean("Activity_Type").alias("activity_type"),
    )


def stage_sleep(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("sleep_key").cast("long").alias("sleep_key"),
        clean_lower("Sleep_Quality").alias("sleep_quality"),
    )


def stage_date(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("date_key").cast("long").alias("date_key"),
        try_date("full_date").alias("full_date"),
        clean("day_of_week").alias("day_of_week"),
        F.col("month").cast("int").alias("month"),
        F.col("year").cast("int").alias("year"),
    )


def stage_fact(raw: DataFrame) -> DataFrame:
    """Strict casts (a bad value raises under ANSI); doubles -> int half to even."""
    whole = ("heart_rate", "stress_level", "step_count")
    return raw.select(*[(to_int(c) if c in whole else F.col(c).cast(t)).alias(c)
                        for c, t in HEALTH_SPECS["fact_health_analytics"].types])


STAGERS = {
    "dim_student": stage_student, "dim_health": stage_health,
    "dim_lifestyle": stage_lifestyle, "dim_activity": stage_activity,
    "dim_sleep": stage_sleep, "dim_date": stage_date,
    "fact_health_analytics": stage_fact,
}

# ---------------------------------------------------------------- intermediate


def current_rows(df: DataFrame, flag_col: str = "is_current", value: str = "YES") -> DataFrame:
    """SCD-2 current snapshot (F-01)."""
    return df.where(F.col(flag_col) == F.lit(value))


def student_features(stg_student: DataFrame, as_of=None, key_col: str = "student_key",
                     id_col: str = "national_id", extra: Sequence[str] = (),
                     current_value: str = "YES") -> DataFrame:
    """Pseudonymised current student rows with derived age (P-10 ... P-13, F-01).

    Raw PII (national id, names, birth date, source age) is not selected.
    ``as_of`` replaces CURRENT_DATE so runs are reproducible.
    """
    s = current_rows(stg_student, "is_current", current_value)
    return s.select(
        F.col(key_col),
        feat.pseudonymise(id_col).alias("national_id_hashed"),
        F.lit(feat.MASKED_NAME).alias("first_name"),
        F.lit(feat.MASKED_NAME).alias("last_name"),
        F.col("gender"),
        feat.age_years("date_of_birth", "age_raw", as_of).alias("age_derived"),
        F.col("start_date"), F.col("end_date"), F.col("is_current"),
        *[F.col(c) for c in extra],
    )


@dataclass(frozen=True)
class FeatureParams:
    """Thresholds, ranges and code books of the engineered features."""

    bmi_bands: tuple = feat.BMI_BANDS
    bmi_else: str = feat.BMI_ELSE
    sleep_threshold: float = feat.SLEEP_ADEQUATE_HOURS
    water_threshold: float = feat.HYDRATION_ADEQUATE_LITRES
    score_parts: tuple = feat.ACTIVITY_SCORE_PARTS
    trend_bands: tuple = feat.TREND_BANDS
    trend_else: str = feat.TREND_ELSE
    sleep_order: dict = field(default_factory=lambda: dict(feat.SLEEP_QUALITY_ORDER))
    activity_order: dict = field(default_factory=lambda: dict(feat.ACTIVITY_LEVEL_ORDER))
    smoking_order: dict = field(default_factory=lambda: dict(feat.SMOKING_ALCOHOL_ORDER))
    diet_values: tuple = feat.DIET_VALUES
    gender_values: tuple = feat.GENDER_VALUES


def feature_columns(p: FeatureParams) -> list[Column]:
    """The engineered columns of the enriched fact (P-14 ... P-19)."""
    return [
        feat.band("bmi", p.bmi_bands, p.bmi_else).alias("bmi_class"),
        feat.flag_ge("sleep_duration", p.sleep_threshold).alias("sleep_adequate"),
        feat.flag_ge("water_intake", p.water_threshold).alias("hydration_adequate"),
        feat.weighted_score(p.score_parts).alias("composite_activity_score"),
        feat.ordinal("sleep_quality", p.sleep_order).alias("sleep_quality_encoded"),
        feat.ordinal("physical_activity_level", p.activity_order).alias("physical_activity_encoded"),
        feat.ordinal("smoking_alcohol", p.smoking_order).alias("smoking_alcohol_encoded"),
        *feat.one_hot("diet_type", p.diet_values),
        *feat.one_hot("gender", p.gender_values),
    ]


def add_features(df: DataFrame, params: FeatureParams | None = None) -> DataFrame:
    """Append the engineered features and the trend band (P-14 ... P-20)."""
    p = params or FeatureParams()
    out = df.select("*", *feature_columns(p))
    return out.withColumn("health_trend_indicator",
                          feat.band_ge("composite_activity_score", p.trend_bands, p.trend_else))


ENRICHED_BASE = (
    "fact_id", "student_key", "date_key",
    "bmi", "heart_rate", "stress_level", "sleep_duration", "step_count", "exercise_duration",
    "calorie_expenditure", "water_intake",
    "health_condition", "severity_level", "treatment_type",
    "diet_type", "smoking_alcohol", "physical_activity_level", "activity_type", "sleep_quality",
    "full_date", "day_of_week", "month", "year",
    "national_id_hashed", "gender", "age_derived", "start_date", "end_date",
)


def fact_enriched(stg: dict[str, DataFrame], features: DataFrame,
                  params: FeatureParams | None = None) -> DataFrame:
    """Six inner joins of the fact with its dimensions plus features (J-01 ... J-07).

    Facts whose student has no current row are dropped (J-06).
    """
    dims = [
        Dim(stg["dim_health"], "health_key", "health_key", name="health"),
        Dim(stg["dim_lifestyle"], "lifestyle_key", "lifestyle_key", name="lifestyle"),
        Dim(stg["dim_activity"], "activity_key", "activity_key", name="activity"),
        Dim(stg["dim_sleep"], "sleep_key", "sleep_key", name="sleep"),
        Dim(stg["dim_date"], "date_key", "date_key", name="date"),
        Dim(features.drop("first_name", "last_name", "is_current"), "student_key", "student_key",
            name="student"),
    ]
    joined = star_join(stg["fact_health_analytics"], dims)
    return add_features(joined.select(*ENRICHED_BASE), params)


# ---------------------------------------------------------------- marts (P-08, P-09)

MART_FACT_TAIL = (
    "national_id_hashed", "gender", "age_derived", "start_date", "end_date",
    "full_date", "day_of_week", "month", "year",
    "health_condition", "severity_level", "treatment_type",
    "diet_type", "smoking_alcohol", "physical_activity_level", "activity_type", "sleep_quality",
    "bmi", "heart_rate", "stress_level", "sleep_duration", "step_count", "exercise_duration",
    "calorie_expenditure", "water_intake",
    "bmi_class", "sleep_adequate", "hydration_adequate", "composite_activity_score",
    "health_trend_indicator",
    "sleep_quality_encoded", "physical_activity_encoded", "smoking_alcohol_encoded",
    "diet_veg", "diet_non_veg", "diet_balanced",
    "gender_male", "gender_female", "gender_other",
)


def mart_fact(enriched: DataFrame, key_cols: Sequence[str] = ("fact_id",)) -> DataFrame:
    """The published fact: keys, demographics (no raw PII), measures, features."""
    return enriched.select(*key_cols, "student_key", "date_key", *MART_FACT_TAIL)


MART_DIM_COLUMNS = ("student_key", "national_id_hashed", "first_name", "last_name", "gender",
                    "age_derived", "start_date", "end_date", "is_current")


def mart_dim(features: DataFrame) -> DataFrame:
    return features.select(*MART_DIM_COLUMNS)


# ---------------------------------------------------------------- metrics (A-01 ... A-05)


def metric_distribution(fact: DataFrame) -> DataFrame:
    """Health distribution by condition, gender and diet (A-01, W-01, W-02)."""
    return grouped_metrics(
        fact, ["health_condition", "gender", "diet_type"],
        [ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("bmi").alias("avg_bmi"),
         ravg("sleep_duration").alias("avg_sleep_hours"),
         ravg("stress_level").alias("avg_stress_level"),
         count_if("sleep_adequate").alias("sleep_adequate_count"),
         count_if("hydration_adequate").alias("hydration_adequate_count")],
        shares={"pct_of_total": (), "pct_within_condition": ("health_condition",)},
        columns=["health_condition", "gender", "diet_type", "record_count", "pct_of_total",
                 "pct_within_condition", "avg_activity_score", "avg_bmi", "avg_sleep_hours",
                 "avg_stress_level", "sleep_adequate_count", "hydration_adequate_count"])


def metric_bmi_by_gender(fact: DataFrame) -> DataFrame:
    """BMI statistics by gender, band and condition (A-02)."""
    return grouped_metrics(
        fact, ["gender", "bmi_class", "health_condition"],
        [ravg("bmi").alias("avg_bmi"),
         dround(F.min("bmi"), 2).alias("min_bmi"),
         dround(F.max("bmi"), 2).alias("max_bmi"),
         dround(exact_stddev("bmi"), 2).alias("stddev_bmi"),
         ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("age_derived", 1).alias("avg_age"),
         ravg("calorie_expenditure", 0).alias("avg_calories"),
         count_if("sleep_adequate").alias("sleep_adequate_count")])


def metric_sleep_adequacy(fact: DataFrame) -> DataFrame:
    """Sleep adequacy by condition, quality and flag (A-03, W-02, W-03)."""
    return grouped_metrics(
        fact, ["health_condition", "sleep_quality", "sleep_adequate"],
        [ravg("sleep_duration").alias("avg_sleep_hours"),
         dround(F.min("sleep_duration"), 2).alias("min_sleep_hours"),
         dround(F.max("sleep_duration"), 2).alias("max_sleep_hours"),
         ravg("stress_level").alias("avg_stress_level"),
         ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("heart_rate", 1).alias("avg_heart_rate")],
        shares={"pct_within_condition": ("health_condition",),
                "pct_within_quality": ("sleep_quality",)},
        columns=["health_condition", "sleep_quality", "sleep_adequate", "record_count",
                 "pct_within_condition", "pct_within_quality", "avg_sleep_hours",
                 "min_sleep_hours", "max_sleep_hours", "avg_stress_level",
                 "avg_activity_score", "avg_heart_rate"])


def metric_weekly_activity(fact: DataFrame) -> DataFrame:
    """Weekly activity by year, month, week of month and condition (A-04, P-21, F-02)."""
    return grouped_metrics(
        fact.where(F.col("full_date").isNotNull())
            .withColumn("week_of_month", week_of_month("full_date")),
        ["year", "month", "week_of_month", "health_condition"],
        [ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("sleep_duration").alias("avg_sleep_hours"),
         ravg("heart_rate", 1).alias("avg_heart_rate"),
         ravg("step_count", 0).alias("avg_steps"),
         ravg("exercise_duration").alias("avg_exercise_mins"),
         ravg("calorie_expenditure", 0).alias("avg_calories"),
         ravg("water_intake").alias("avg_water_intake"),
         ravg("bmi").alias("avg_bmi"),
         count_if("sleep_adequate").alias("adequate_sleep_count"),
         count_if("hydration_adequate").alias("adequate_hydration_count"),
         rate("sleep_adequate").alias("sleep_adequacy_rate_pct")],
        count_name="student_count")


RISK_KEYS = ("health_condition", "physical_activity_level", "smoking_alcohol", "diet_type",
             "sleep_quality", "activity_type")


def metric_risk_correlations(fact: DataFrame) -> DataFrame:
    """Six-way behavioural cross table per condition (A-05, W-02)."""
    return grouped_metrics(
        fact, list(RISK_KEYS),
        [ravg("bmi").alias("avg_bmi"),
         ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("sleep_duration").alias("avg_sleep_hours"),
         ravg("stress_level").alias("avg_stress_level"),
         ravg("water_intake").alias("avg_water_intake"),
         ravg("heart_rate", 1).alias("avg_heart_rate"),
         ravg("exercise_duration").alias("avg_exercise_mins"),
         ravg("step_count", 0).alias("avg_steps"),
         count_if("hydration_adequate").alias("hydration_adequate_count"),
         count_if("sleep_adequate").alias("sleep_adequate_count"),
         rate("hydration_adequate").alias("hydration_rate_pct"),
         rate("sleep_adequate").alias("sleep_adequate_rate_pct")],
        shares={"pct_within_condition": ("health_condition",)},
        columns=[*RISK_KEYS, "record_count", "pct_within_condition", "avg_bmi",
                 "avg_activity_score", "avg_sleep_hours", "avg_stress_level",
                 "avg_water_intake", "avg_heart_rate", "avg_exercise_mins", "avg_steps",
                 "hydration_adequate_count", "sleep_adequate_count", "hydration_rate_pct",
                 "sleep_adequate_rate_pct"])


def class_balance(distribution: DataFrame) -> DataFrame:
    """Per condition: total records and the *sum of rounded shares* (A-06)."""
    return reaggregate(distribution, ["health_condition"], {"total_records": "record_count"},
                       {"pct_of_total": ("pct_of_total", 2)})


METRICS = {
    "mrt_health_distribution": metric_distribution,
    "mrt_bmi_by_gender": metric_bmi_by_gender,
    "mrt_sleep_adequacy": metric_sleep_adequacy,
    "mrt_weekly_activity": metric_weekly_activity,
    "mrt_risk_correlations": metric_risk_correlations,
}

# Stored order of each metric table (O-01, O-02): (column, descending).  Spark
# does not keep an order in a stored table, so the read queries apply it.
METRIC_ORDER = {
    "mrt_health_distribution": (("health_condition", False), ("gender", False),
                                ("diet_type", False)),
    "mrt_bmi_by_gender": (("gender", False), ("bmi_class", False), ("health_condition", False)),
    "mrt_sleep_adequacy": (("health_condition", False), ("sleep_quality", False),
                           ("sleep_adequate", True)),
    "mrt_weekly_activity": (("year", False), ("month", False), ("week_of_month", False),
                            ("health_condition", False)),
    "mrt_risk_correlations": (("health_condition", False), ("record_count", True)),
}


def sort_columns(spec) -> list[Column]:
    """NULLS LAST in both directions (the reference engine's default)."""
    return [F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in spec]
