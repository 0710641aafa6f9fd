"""Binding of the star models to the driver's order tables.

The driver tables form a snowflake::

    lineitem --l_orderkey--> orders --o_custkey--> customer
             --l_partkey---> part
             --l_suppkey---> supplier --s_nationkey--> nation --n_regionkey--> region

Each table is staged into the column names of the health star, then the
very same ``models`` functions (features, marts, metrics) run on it.

Role binding (driver column -> star column):

==========================  ==============================================
``lower(o_orderpriority)``  ``health_condition`` (the class)
``lower(c_mktsegment)``     ``gender``
``lower(p_type)``           ``diet_type``
``p_size`` banded 10 / 30    ``physical_activity_level``
``p_brand``                 ``activity_type``
``lower(l_returnflag)``     ``sleep_quality``
``lower(l_linestatus)``     ``smoking_alcohol``
``lower(r_name)``           ``severity_level``;  ``n_name`` -> ``treatment_type``
``l_quantity``              ``bmi`` and ``exercise_duration``
``l_quantity / 2`` (int)    ``heart_rate`` (half-to-even rounding)
``l_tax * 100`` (int)       ``stress_level``
``l_discount``              ``sleep_duration`` (adequate at >= 0.05)
``l_tax``                   ``water_intake`` (adequate at >= 0.04)
``l_extendedprice`` (int)   ``step_count``
``o_totalprice``            ``calorie_expenditure``
``l_shipdate`` as DATE      ``full_date``; ``date_key`` = yyyymmdd
``o_custkey``, ``c_name``   ``student_key``, identifier to pseudonymise
``o_orderdate`` as DATE     birth date for the age (as of 2002-01-01)
``upper(o_orderstatus)``    ``is_current`` (current rows: ``'O'``)
==========================  ==============================================
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import features as feat
from starmart.functions.dates import to_date
from starmart.functions.numeric import to_int
from starmart.functions.text import clean, clean_lower, clean_upper
from starmart.operators.star import Dim, star_join
from starmart.plans import models as M
from starmart.specs import DRIVER_SCHEMAS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FACT_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
AS_OF = _dt.date(2002, 1, 1)
CURRENT_STATUS = "O"

# Fixed parameters of the binding (ranges of the score inputs, thresholds and
# code books over the driver's category values).
DRIVER_PARAMS = M.FeatureParams(
    sleep_threshold=0.05,
    water_threshold=0.04,
    score_parts=(("step_count", 901.0, 104998.0, 40.0),
                 ("exercise_duration", 1.0, 50.0, 35.0),
                 ("calorie_expenditure", 1000.0, 500000.0, 25.0)),
    sleep_order={"r": 1, "a": 2, "n": 3},
    activity_order={"sedentary": 1, "moderate": 2, "active": 3},
    smoking_order={"f": 1, "o": 2},
    diet_values=(("economy", "diet_veg"), ("standard", "diet_non_veg"),
                 ("small", "diet_balanced")),
    gender_values=(("household", "gender_male"), ("machinery", "gender_female"),
                   ("building", "gender_other")),
)
SIZE_BANDS = ((10.0, "sedentary"), (30.0, "moderate"))
SIZE_ELSE = "active"

# nation and region have a fixed size in the TPC-H model (25 and 5 rows); the
# broadcast is still guarded by a row-count check.
SMALL_DIM_ROWS = 10_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the declared schema (no footer inference)."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: read(spark, sf_dir, n) for n in names}


# ---------------------------------------------------------------- staging projections


def stage_fact(lineitem: DataFrame) -> DataFrame:
    d = to_date("l_shipdate")
    return lineitem.select(
        *FACT_KEYS,
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long").alias("date_key"),
        F.col("l_quantity").cast("double").alias("bmi"),
        to_int(F.col("l_quantity") / F.lit(2.0)).alias("heart_rate"),
        to_int(F.col("l_tax") * F.lit(100.0)).alias("stress_level"),
        F.col("l_discount").cast("double").alias("sleep_duration"),
        to_int("l_extendedprice").alias("step_count"),
        F.col("l_quantity").cast("double").alias("exercise_duration"),
        F.col("l_tax").cast("double").alias("water_intake"),
        clean_lower("l_returnflag").alias("sleep_quality"),
        clean_lower("l_linestatus").alias("smoking_alcohol"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
    )


def stage_students(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """orders joined to customer: one SCD-style row per order (all rows)."""
    o = orders.select(
        "o_orderkey", "o_custkey",
        to_date("o_orderdate").alias("date_of_birth"),
        clean_upper("o_orderstatus").alias("is_current"),
        clean_lower("o_orderpriority").alias("health_condition"),
        F.col("o_totalprice").cast("double").alias("calorie_expenditure"))
    c = customer.select(
        F.col("c_custkey"),
        F.col("c_name").cast("string").alias("national_id"),
        clean_lower("c_mktsegment").alias("gender"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("age_raw"))
    s = star_join(o, [Dim(c, "o_custkey", "c_custkey", name="customer")])
    return s.select(
        F.col("o_orderkey"), F.col("o_custkey").alias("student_key"), "national_id", "gender",
        "age_raw", "date_of_birth", F.col("date_of_birth").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"), "is_current", "health_condition",
        "calorie_expenditure")


def student_features(orders: DataFrame, customer: DataFrame, as_of=AS_OF) -> DataFrame:
    """Pseudonymised current rows, keyed by ``o_orderkey`` (F-01, P-10 ... P-13)."""
    staged = stage_students(orders, customer)
    return M.student_features(staged, as_of=as_of,
                              extra=("o_orderkey", "health_condition", "calorie_expenditure"),
                              current_value=CURRENT_STATUS)


def stage_lifestyle(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        clean_lower("p_type").alias("diet_type"),
        feat.band("p_size", SIZE_BANDS, SIZE_ELSE).alias("physical_activity_level"),
        clean("p_brand").alias("activity_type"))


def stage_place(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """supplier -> nation -> region, the two fixed-size tables broadcast."""
    n = nation.select("n_nationkey", "n_regionkey", clean("n_name").alias("treatment_type"))
    r = region.select("r_regionkey", clean_lower("r_name").alias("severity_level"))
    nr = star_join(n, [Dim(r, "n_regionkey", "r_regionkey", name="region",
                           broadcast_max_rows=SMALL_DIM_ROWS)])
    return star_join(supplier.select("s_suppkey", "s_nationkey"),
                     [Dim(nr, "s_nationkey", "n_nationkey", ["severity_level", "treatment_type"],
                          broadcast_max_rows=SMALL_DIM_ROWS, name="nation")]) \
        .select("s_suppkey", "severity_level", "treatment_type")


# ---------------------------------------------------------------- enriched star


def enriched(spark: SparkSession, sf_dir: str, as_of=AS_OF, skew_buckets: int = 0) -> DataFrame:
    """The enriched fact over the driver tables (J-01 ... J-07, P-14 ... P-20).

    Join order keeps the big shuffles on the fact's own keys: the student
    dimension (orders x customer) is built first from the smaller tables,
    then the fact meets it on ``l_orderkey``, part on ``l_partkey`` and the
    supplier chain on ``l_suppkey``.  ``skew_buckets > 1`` salts hot foreign
    keys explicitly (otherwise AQE's skew-join split handles them).
    """
    t = tables(spark, sf_dir, "lineitem", "orders", "customer", "part", "supplier", "nation",
               "region")
    students = student_features(t["orders"], t["customer"], as_of)
    dims = [
        Dim(students, "l_orderkey", "o_orderkey",
            ["student_key", "national_id_hashed", "gender", "age_derived", "start_date",
             "end_date", "health_condition", "calorie_expenditure"], name="student",
            skew_buckets=skew_buckets),
        Dim(stage_lifestyle(t["part"]), "l_partkey", "p_partkey",
            ["diet_type", "physical_activity_level", "activity_type"], name="part",
            skew_buckets=skew_buckets),
        Dim(stage_place(t["supplier"], t["nation"], t["region"]), "l_suppkey", "s_suppkey",
            ["severity_level", "treatment_type"], name="place", skew_buckets=skew_buckets),
    ]
    joined = star_join(stage_fact(t["lineitem"]), dims)
    return M.add_features(joined, DRIVER_PARAMS)


def mart_fact(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    """The published fact over the driver tables (P-09), keyed by ``FACT_KEYS``."""
    return M.mart_fact(enriched(spark, sf_dir, as_of), FACT_KEYS)


def mart_dim(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    """The published student dimension (P-08): one row per current order.

    A customer has many orders, so the row key is ``o_orderkey``.
    """
    t = tables(spark, sf_dir, "orders", "customer")
    return student_features(t["orders"], t["customer"], as_of).select(
        "o_orderkey", *M.MART_DIM_COLUMNS)
