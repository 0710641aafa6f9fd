"""Plain SQL (DuckDB dialect) for each registered query: the correctness oracle.

The driver runs these on the same Parquet tables and compares row count,
schema and an order-insensitive value hash with the Spark result, so every
output column carries the same name and type as the Spark query.
"""

from __future__ import annotations

# The driver star in SQL.  Independent of the Spark code path: only the role
# binding (documented in plans/driver.py) is shared.
STAR_CTE = """
students AS (
  SELECT o.o_orderkey,
         o.o_custkey AS student_key,
         md5(CAST(c.c_name AS VARCHAR)) AS national_id_hashed,
         'PSEUDONYMISED' AS first_name,
         'PSEUDONYMISED' AS last_name,
         lower(trim(c.c_mktsegment)) AS gender,
         CASE WHEN CAST(o.o_orderdate AS DATE) IS NOT NULL
              THEN CAST(datediff('year', CAST(o.o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER)
              ELSE CAST(c.c_acctbal / 100.0 AS INTEGER) END AS age_derived,
         CAST(o.o_orderdate AS DATE) AS start_date,
         CAST(NULL AS DATE) AS end_date,
         upper(trim(o.o_orderstatus)) AS is_current,
         lower(trim(o.o_orderpriority)) AS health_condition,
         CAST(o.o_totalprice AS DOUBLE) AS calorie_expenditure
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE upper(trim(o.o_orderstatus)) = 'O'
),
lifestyle AS (
  SELECT p_partkey,
         lower(trim(p_type)) AS diet_type,
         CASE WHEN CAST(p_size AS DOUBLE) < 10.0 THEN 'sedentary'
              WHEN CAST(p_size AS DOUBLE) < 30.0 THEN 'moderate'
              ELSE 'active' END AS physical_activity_level,
         trim(p_brand) AS activity_type
  FROM part
),
place AS (
  SELECT s.s_suppkey, lower(trim(r.r_name)) AS severity_level, trim(n.n_name) AS treatment_type
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
fact AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(year(CAST(l_shipdate AS DATE)) * 10000 + month(CAST(l_shipdate AS DATE)) * 100
              + day(CAST(l_shipdate AS DATE)) AS BIGINT) AS date_key,
         CAST(l_quantity AS DOUBLE) AS bmi,
         CAST(l_quantity / 2.0 AS INTEGER) AS heart_rate,
         CAST(l_tax * 100.0 AS INTEGER) AS stress_level,
         CAST(l_discount AS DOUBLE) AS sleep_duration,
         CAST(l_extendedprice AS INTEGER) AS step_count,
         CAST(l_quantity AS DOUBLE) AS exercise_duration,
         CAST(l_tax AS DOUBLE) AS water_intake,
         lower(trim(l_returnflag)) AS sleep_quality,
         lower(trim(l_linestatus)) AS smoking_alcohol,
         CAST(l_shipdate AS DATE) AS full_date,
         dayname(CAST(l_shipdate AS DATE)) AS day_of_week,
         CAST(month(CAST(l_shipdate AS DATE)) AS INTEGER) AS month,
         CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year
  FROM lineitem
),
joined AS (
  SELECT f.*, s.student_key, s.national_id_hashed, s.gender, s.age_derived, s.start_date,
         s.end_date, s.health_condition, s.calorie_expenditure,
         l.diet_type, l.physical_activity_level, l.activity_type,
         p.severity_level, p.treatment_type
  FROM fact f
  JOIN students s ON f.l_orderkey = s.o_orderkey
  JOIN lifestyle l ON f.l_partkey = l.p_partkey
  JOIN place p ON f.l_suppkey = p.s_suppkey
),
scored AS (
  SELECT *,
    CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25.0 THEN 'Normal'
         WHEN bmi < 30.0 THEN 'Overweight' ELSE 'Obese' END AS bmi_class,
    CASE WHEN sleep_duration >= 0.05 THEN TRUE ELSE FALSE END AS sleep_adequate,
    CASE WHEN water_intake >= 0.04 THEN TRUE ELSE FALSE END AS hydration_adequate,
    ROUND(LEAST(100.0, GREATEST(0.0,
        COALESCE((CAST(step_count AS DOUBLE) - 901.0) / (104998.0 - 901.0) * 40.0, 0.0)
      + COALESCE((exercise_duration - 1.0) / (50.0 - 1.0) * 35.0, 0.0)
      + COALESCE((calorie_expenditure - 1000.0) / (500000.0 - 1000.0) * 25.0, 0.0))), 2)
      AS composite_activity_score,
    CASE sleep_quality WHEN 'r' THEN 1 WHEN 'a' THEN 2 WHEN 'n' THEN 3 END AS sleep_quality_encoded,
    CASE physical_activity_level WHEN 'sedentary' THEN 1 WHEN 'moderate' THEN 2
         WHEN 'active' THEN 3 END AS physical_activity_encoded,
    CASE smoking_alcohol WHEN 'f' THEN 1 WHEN 'o' THEN 2 END AS smoking_alcohol_encoded,
    CASE WHEN diet_type = 'economy' THEN 1 ELSE 0 END AS diet_veg,
    CASE WHEN diet_type = 'standard' THEN 1 ELSE 0 END AS diet_non_veg,
    CASE WHEN diet_type = 'small' THEN 1 ELSE 0 END AS diet_balanced,
    CASE WHEN gender = 'household' THEN 1 ELSE 0 END AS gender_male,
    CASE WHEN gender = 'machinery' THEN 1 ELSE 0 END AS gender_female,
    CASE WHEN gender = 'building' THEN 1 ELSE 0 END AS gender_other
  FROM joined
),
star AS (
  SELECT *,
    CASE WHEN composite_activity_score >= 65.0 THEN 'improving'
         WHEN composite_activity_score >= 35.0 THEN 'stable'
         ELSE 'declining' END AS health_trend_indicator
  FROM scored
)"""


def avg_sql(expr: str, digits: int) -> str:
    """Exact average rounded: decimal sum / count (see functions.numeric.exact_avg)."""
    return f"ROUND(CAST(SUM(CAST({expr} AS DECIMAL(38,9))) AS DOUBLE) / COUNT({expr}), {digits})"


def with_star(body: str) -> str:
    return f"WITH {STAR_CTE}\n{body}"


MART_FACT_COLUMNS = """l_orderkey, l_linenumber, l_partkey, l_suppkey, student_key, date_key,
  national_id_hashed, gender, age_derived, start_date, end_date,
  full_date, day_of_week, month, year,
  health_condition, severity_level, treatment_type,
  diet_type, smoking_alcohol, physical_activity_level, activity_type, sleep_quality,
  bmi, heart_rate, stress_level, sleep_duration, step_count, exercise_duration,
  calorie_expenditure, water_intake,
  bmi_class, sleep_adequate, hydration_adequate, composite_activity_score,
  health_trend_indicator,
  sleep_quality_encoded, physical_activity_encoded, smoking_alcohol_encoded,
  diet_veg, diet_non_veg, diet_balanced, gender_male, gender_female, gender_other"""

def metric_sql(keys, measures, shares=None, where="TRUE", derived="", count="record_count"):
    """SQL of a metric: its groups, then shares against totals of their own.

    ``measures`` maps output names to aggregates over the star, ``shares``
    output names to the keys whose groups the share is of.
    """
    names = ", ".join(keys)
    aggregates = "".join(f",\n    {sql} AS {name}" for name, sql in measures.items())
    groups = (f"chosen AS (SELECT *{derived} FROM star WHERE {where}),\n"
              f"groups AS (SELECT {names}, COUNT(*) AS {count}{aggregates} FROM chosen "
              f"GROUP BY {names})")
    totals, joins, parts = "", "", ""
    for i, (name, of) in enumerate((shares or {}).items()):
        t, by = f"total{i}", ", ".join(of)
        select = f"{by}, " if of else ""
        totals += (f",\n{t} AS (SELECT {select}CAST(SUM({count}) AS BIGINT) AS n FROM groups"
                   + (f" GROUP BY {by})" if of else ")"))
        on = " AND ".join(f"groups.{c} IS NOT DISTINCT FROM {t}.{c}" for c in of) or "TRUE"
        joins += f" JOIN {t} ON {on}"
        parts += f", ROUND(groups.{count} * 100.0 / {t}.n, 2) AS {name}"
    return with_star(f",\n{groups}{totals}\nSELECT groups.*{parts} FROM groups{joins}")


def flagged(flag):
    return f"COUNT(*) FILTER (WHERE {flag})"


def flagged_pct(flag):
    return f"ROUND({flagged(flag)} * 100.0 / COUNT(*), 2)"


def rounded(fn, column):
    return f"ROUND({fn}({column}), 2)"


METRIC_DISTRIBUTION = metric_sql(
    ("health_condition", "gender", "diet_type"),
    {"avg_activity_score": avg_sql("composite_activity_score", 2), "avg_bmi": avg_sql("bmi", 2),
     "avg_sleep_hours": avg_sql("sleep_duration", 2),
     "avg_stress_level": avg_sql("stress_level", 2),
     "sleep_adequate_count": flagged("sleep_adequate"),
     "hydration_adequate_count": flagged("hydration_adequate")},
    {"pct_of_total": (), "pct_within_condition": ("health_condition",)})

METRIC_BMI = metric_sql(
    ("gender", "bmi_class", "health_condition"),
    {"avg_bmi": avg_sql("bmi", 2), "min_bmi": rounded("MIN", "bmi"),
     "max_bmi": rounded("MAX", "bmi"), "stddev_bmi": rounded("STDDEV_SAMP", "bmi"),
     "avg_activity_score": avg_sql("composite_activity_score", 2),
     "avg_age": avg_sql("age_derived", 1), "avg_calories": avg_sql("calorie_expenditure", 0),
     "sleep_adequate_count": flagged("sleep_adequate")})

METRIC_SLEEP = metric_sql(
    ("health_condition", "sleep_quality", "sleep_adequate"),
    {"avg_sleep_hours": avg_sql("sleep_duration", 2),
     "min_sleep_hours": rounded("MIN", "sleep_duration"),
     "max_sleep_hours": rounded("MAX", "sleep_duration"),
     "avg_stress_level": avg_sql("stress_level", 2),
     "avg_activity_score": avg_sql("composite_activity_score", 2),
     "avg_heart_rate": avg_sql("heart_rate", 1)},
    {"pct_within_condition": ("health_condition",), "pct_within_quality": ("sleep_quality",)})

METRIC_WEEKLY = metric_sql(
    ("year", "month", "week_of_month", "health_condition"),
    {"avg_activity_score": avg_sql("composite_activity_score", 2),
     "avg_sleep_hours": avg_sql("sleep_duration", 2), "avg_heart_rate": avg_sql("heart_rate", 1),
     "avg_steps": avg_sql("step_count", 0), "avg_exercise_mins": avg_sql("exercise_duration", 2),
     "avg_calories": avg_sql("calorie_expenditure", 0),
     "avg_water_intake": avg_sql("water_intake", 2), "avg_bmi": avg_sql("bmi", 2),
     "adequate_sleep_count": flagged("sleep_adequate"),
     "adequate_hydration_count": flagged("hydration_adequate"),
     "sleep_adequacy_rate_pct": flagged_pct("sleep_adequate")},
    where="full_date IS NOT NULL", count="student_count",
    derived=", CAST((EXTRACT(DAY FROM full_date) + 6) // 7 AS INTEGER) AS week_of_month")

METRIC_RISK = metric_sql(
    ("health_condition", "physical_activity_level", "smoking_alcohol", "diet_type",
     "sleep_quality", "activity_type"),
    {"avg_bmi": avg_sql("bmi", 2), "avg_activity_score": avg_sql("composite_activity_score", 2),
     "avg_sleep_hours": avg_sql("sleep_duration", 2),
     "avg_stress_level": avg_sql("stress_level", 2),
     "avg_water_intake": avg_sql("water_intake", 2), "avg_heart_rate": avg_sql("heart_rate", 1),
     "avg_exercise_mins": avg_sql("exercise_duration", 2),
     "avg_steps": avg_sql("step_count", 0),
     "hydration_adequate_count": flagged("hydration_adequate"),
     "sleep_adequate_count": flagged("sleep_adequate"),
     "hydration_rate_pct": flagged_pct("hydration_adequate"),
     "sleep_adequate_rate_pct": flagged_pct("sleep_adequate")},
    {"pct_within_condition": ("health_condition",)})

CLASS_BALANCE = with_star("""
, dist AS (
  SELECT health_condition, gender, diet_type, COUNT(*) AS record_count,
    ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct_of_total
  FROM star GROUP BY health_condition, gender, diet_type
)
SELECT health_condition, CAST(SUM(record_count) AS BIGINT) AS total_records,
  ROUND(SUM(pct_of_total), 2) AS pct_of_total
FROM dist GROUP BY health_condition""")

STAR_ENRICHED = with_star("SELECT * FROM star")

MART_FACT = with_star(f"SELECT {MART_FACT_COLUMNS} FROM star")

ORACLE: dict[str, str] = {
    "metric_distribution": METRIC_DISTRIBUTION,
    "metric_band_by_group": METRIC_BMI,
    "metric_adequacy": METRIC_SLEEP,
    "metric_weekly": METRIC_WEEKLY,
    "metric_risk": METRIC_RISK,
    "class_balance": CLASS_BALANCE,
    "star_enriched": STAR_ENRICHED,
    "mart_fact": MART_FACT,
}

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
RECORD_COLUMNS = f"""{KEYS}, student_key, national_id_hashed, gender, age_derived,
  health_condition, severity_level, treatment_type, bmi, bmi_class, heart_rate,
  sleep_duration, sleep_adequate, sleep_quality, step_count, exercise_duration,
  calorie_expenditure, water_intake, hydration_adequate, stress_level,
  physical_activity_level, activity_type, diet_type, smoking_alcohol,
  composite_activity_score, health_trend_indicator, CAST(full_date AS VARCHAR) AS full_date"""
# Total order of a page: the keys, then every other record column.
RECORD_ORDER = ", ".join(c.strip() for c in RECORD_COLUMNS.replace(
    "CAST(full_date AS VARCHAR) AS full_date", "CAST(full_date AS VARCHAR)").split(","))

STAGE_ORDERS = """
SELECT o.o_orderkey, o.o_custkey AS student_key, CAST(c.c_name AS VARCHAR) AS national_id,
  lower(trim(c.c_mktsegment)) AS gender, c.c_acctbal / 100.0 AS age_raw,
  CAST(o.o_orderdate AS DATE) AS date_of_birth, CAST(o.o_orderdate AS DATE) AS start_date,
  CAST(NULL AS DATE) AS end_date, upper(trim(o.o_orderstatus)) AS is_current,
  lower(trim(o.o_orderpriority)) AS health_condition,
  CAST(o.o_totalprice AS DOUBLE) AS calorie_expenditure
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

AGE_DERIVED = f"""
SELECT o_orderkey, date_of_birth,
  CASE WHEN date_of_birth IS NOT NULL
       THEN CAST(datediff('year', date_of_birth, DATE '2002-01-01') AS INTEGER)
       ELSE CAST(age_raw AS INTEGER) END AS age_derived
FROM ({STAGE_ORDERS}) s"""

BAND_QUANTITY = f"""
SELECT {KEYS}, l_quantity,
  CASE WHEN l_quantity < 18.5 THEN 'Underweight' WHEN l_quantity < 25.0 THEN 'Normal'
       WHEN l_quantity < 30.0 THEN 'Overweight' ELSE 'Obese' END AS bmi_class
FROM lineitem"""

THRESHOLD_FLAGS = f"""
SELECT {KEYS},
  CASE WHEN l_discount >= 0.05 THEN TRUE ELSE FALSE END AS sleep_adequate,
  CASE WHEN l_tax >= 0.04 THEN TRUE ELSE FALSE END AS hydration_adequate
FROM lineitem"""

ORDINAL_ENCODE = with_star(f"""
SELECT {KEYS},
  CASE sleep_quality WHEN 'r' THEN 1 WHEN 'a' THEN 2 WHEN 'n' THEN 3 END AS sleep_quality_encoded,
  CASE smoking_alcohol WHEN 'f' THEN 1 WHEN 'o' THEN 2 END AS smoking_alcohol_encoded
FROM fact""")

ONE_HOT_ENCODE = """
SELECT c_custkey,
  CASE WHEN lower(trim(c_mktsegment)) = 'household' THEN 1 ELSE 0 END AS gender_male,
  CASE WHEN lower(trim(c_mktsegment)) = 'machinery' THEN 1 ELSE 0 END AS gender_female,
  CASE WHEN lower(trim(c_mktsegment)) = 'building' THEN 1 ELSE 0 END AS gender_other
FROM customer"""

WEEK_OF_MONTH = f"""
SELECT {KEYS}, CAST(l_shipdate AS DATE) AS full_date,
  CAST(CEIL(EXTRACT(DAY FROM CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER) AS week_of_month
FROM lineitem"""

MART_BOOL_AS_INT = MART_FACT_COLUMNS.replace(
    "sleep_adequate, hydration_adequate",
    "CAST(sleep_adequate AS INTEGER) AS sleep_adequate, "
    "CAST(hydration_adequate AS INTEGER) AS hydration_adequate")

CONTRACT_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}


def _contract_sql() -> str:
    parts = []
    for t, cols in CONTRACT_COLUMNS.items():
        names = ", ".join(f"'{c}'" for c in cols)
        parts.append(
            f"SELECT '{t}' AS table_name, 'required_columns' AS check_name, 'error' AS severity, "
            f"CAST(COUNT(*) AS BIGINT) AS observed, CAST({len(cols)} AS BIGINT) AS expected, "
            f"COUNT(*) = {len(cols)} AS passed FROM information_schema.columns "
            f"WHERE table_name = '{t}' AND column_name IN ({names})")
        parts.append(
            f"SELECT '{t}', 'min_rows', 'error', CAST(COUNT(*) AS BIGINT), CAST(1 AS BIGINT), "
            f"COUNT(*) >= 1 FROM {t}")
    return "\nUNION ALL\n".join(parts)


ROW_PARITY = """
SELECT 'lineitem' AS table_name, (SELECT COUNT(*) FROM lineitem) AS source_rows,
       (SELECT COUNT(*) FROM lineitem) AS staged_rows
UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders),
       (SELECT COUNT(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
UNION ALL SELECT 'part', (SELECT COUNT(*) FROM part), (SELECT COUNT(*) FROM part)
UNION ALL SELECT 'supplier', (SELECT COUNT(*) FROM supplier),
       (SELECT COUNT(*) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey)"""
ROW_PARITY = f"SELECT *, source_rows = staged_rows AS parity_ok FROM ({ROW_PARITY}) p"

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")
LAYER_SUMMARY = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in sorted(ALL_TABLES))


_INGEST_KEYS = (("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"),
                ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
                ("lineitem", "l_orderkey"))
INGEST_TABLES = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS parquet_rows, "
    f"COUNT(*) - COUNT({k}) AS null_keys, CAST(0 AS BIGINT) AS cast_failures FROM {t}"
    for t, k in _INGEST_KEYS)

def _null_profile_sql(table: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM {table}" for c in cols)


DUPLICATE_PROFILE = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS total_rows, "
    f"COUNT(DISTINCT {c}) AS distinct_values, COUNT(*) - COUNT(DISTINCT {c}) AS duplicate_count "
    f"FROM {t}"
    for t, c in (("customer", "c_name"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"),
                 ("part", "p_type")))

CHECK_REPORT = with_star(f""", m AS (SELECT {MART_FACT_COLUMNS} FROM star)
SELECT 'mart_fact' AS model, column_name, check_name, CAST(failures AS BIGINT) AS failures FROM (
  SELECT 'health_condition' AS column_name, 'not_null' AS check_name,
         SUM(CASE WHEN health_condition IS NULL THEN 1 ELSE 0 END) AS failures FROM m
  UNION ALL SELECT 'bmi_class', 'not_null', SUM(CASE WHEN bmi_class IS NULL THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'health_trend_indicator', 'not_null',
         SUM(CASE WHEN health_trend_indicator IS NULL THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'composite_activity_score', 'not_null',
         SUM(CASE WHEN composite_activity_score IS NULL THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'bmi', 'not_null', SUM(CASE WHEN bmi IS NULL THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'heart_rate', 'not_null', SUM(CASE WHEN heart_rate IS NULL THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'health_condition', 'accepted_values',
         SUM(CASE WHEN health_condition IS NOT NULL AND health_condition NOT IN
             ('1-urgent', '2-high', '3-medium', '4-not specified', '5-low') THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'bmi_class', 'accepted_values',
         SUM(CASE WHEN bmi_class IS NOT NULL AND bmi_class NOT IN
             ('Underweight', 'Normal', 'Overweight', 'Obese') THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'bmi', 'range',
         SUM(CASE WHEN bmi IS NOT NULL AND (bmi < 1.0 OR bmi > 50.0) THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'composite_activity_score', 'range',
         SUM(CASE WHEN composite_activity_score IS NOT NULL AND
             (composite_activity_score < 0.0 OR composite_activity_score > 100.0)
             THEN 1 ELSE 0 END) FROM m
  UNION ALL SELECT 'l_orderkey+l_linenumber+l_partkey+l_suppkey', 'unique', COUNT(*) FROM (
    SELECT {KEYS} FROM m WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
    GROUP BY {KEYS} HAVING COUNT(*) > 1) u
) r""")

LINEITEM_COLUMNS = CONTRACT_COLUMNS["lineitem"]
ORDERS_COLUMNS = CONTRACT_COLUMNS["orders"]

ORACLE.update({
    "stage_lineitem": with_star("SELECT * FROM fact"),
    "stage_orders": STAGE_ORDERS,
    "stage_part": with_star("SELECT * FROM lifestyle"),
    "stage_supplier": with_star("SELECT * FROM place"),
    "pseudonymised_dim": with_star(
        "SELECT o_orderkey, student_key, national_id_hashed, first_name, last_name, gender, "
        "age_derived, start_date, end_date, is_current FROM students"),
    "age_derived": AGE_DERIVED,
    "band_quantity": BAND_QUANTITY,
    "threshold_flags": THRESHOLD_FLAGS,
    "composite_score": with_star(
        f"SELECT {KEYS}, composite_activity_score, health_trend_indicator FROM star"),
    "trend_band": with_star(
        "SELECT health_condition, health_trend_indicator, COUNT(*) AS record_count "
        "FROM star GROUP BY health_condition, health_trend_indicator"),
    "ordinal_encode": ORDINAL_ENCODE,
    "one_hot_encode": ONE_HOT_ENCODE,
    "week_of_month": WEEK_OF_MONTH,
    "list_records_page": with_star(
        f"SELECT {RECORD_COLUMNS} FROM star WHERE health_condition = '1-urgent' "
        f"ORDER BY {RECORD_ORDER} LIMIT 50 OFFSET 100"),
    "get_record": with_star(f"SELECT {RECORD_COLUMNS} FROM star WHERE l_orderkey = 7"),
    "metric_filtered_sorted": f"SELECT * FROM ({METRIC_RISK}) r WHERE health_condition = '2-high' "
                              f"AND physical_activity_level = 'active'",
    "weekly_filtered": f"SELECT * FROM ({METRIC_WEEKLY}) w WHERE health_condition = '3-medium' "
                       f"AND year = 1997",
    "serving_promoted": with_star(f"SELECT {MART_BOOL_AS_INT} FROM star"),
    "serving_sample": with_star(
        "SELECT student_key, o_orderkey, substr(national_id_hashed, 1, 8) AS hash_prefix, "
        "gender, age_derived FROM students ORDER BY student_key, o_orderkey LIMIT 3"),
    "contract_report": _contract_sql(),
    "row_parity": ROW_PARITY,
    "layer_summary": LAYER_SUMMARY,
    "csv_roundtrip_coerce": "SELECT * FROM customer",
    "ingest_tables": INGEST_TABLES,
    "partitioned_stage": "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, "
                         "CAST(month(l_shipdate) AS INTEGER) AS month, COUNT(*) AS record_count, "
                         "MIN(CAST(l_shipdate AS DATE)) AS first_date, "
                         "MAX(CAST(l_shipdate AS DATE)) AS last_date FROM lineitem GROUP BY 1, 2",
    "null_profile": _null_profile_sql("lineitem", LINEITEM_COLUMNS) + "\nUNION ALL\n"
                    + _null_profile_sql("orders", ORDERS_COLUMNS),
    "duplicate_profile": DUPLICATE_PROFILE,
    "unique_failures": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem "
                       "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL "
                       "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    "check_report": CHECK_REPORT,
    "not_null_failures": with_star(f"SELECT {KEYS} FROM fact WHERE full_date IS NULL"),
})

# ---------------------------------------------------------------- Tier 2 / Tier 3

WEEKLY_PER_USER = """
SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week_start, COUNT(*) AS n_rows,
  ROUND(CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) / COUNT(value), 4) AS avg_value
FROM events GROUP BY user_id, CAST(date_trunc('week', ts) AS DATE)"""

TREND_DIRECTION = f"""
WITH w AS ({WEEKLY_PER_USER}),
l AS (SELECT *, lag(avg_value) OVER (PARTITION BY user_id ORDER BY week_start) AS prev_value
      FROM w)
SELECT user_id, week_start, n_rows, avg_value, prev_value,
  ROUND(avg_value - prev_value, 4) AS delta,
  CASE WHEN prev_value IS NULL THEN NULL
       WHEN ROUND(avg_value - prev_value, 4) > 0.5 THEN 'up'
       WHEN ROUND(avg_value - prev_value, 4) < -0.5 THEN 'down'
       ELSE 'flat' END AS direction
FROM l"""

SCD_AS_OF = f"""
SELECT student_key, o_orderkey, national_id, gender, age_raw, date_of_birth, start_date,
  end_date, is_current, health_condition, calorie_expenditure
FROM (SELECT *, row_number() OVER (PARTITION BY student_key
                                   ORDER BY start_date DESC, o_orderkey DESC) AS rn
      FROM ({STAGE_ORDERS}) s WHERE start_date <= DATE '1998-01-01') x
WHERE rn = 1"""

FK_FAILURES = "\nUNION ALL\n".join(
    f"SELECT '{c}.{ck}->{p}.{pk}' AS relationship, COUNT(*) AS failures FROM {c} x "
    f"WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})"
    for c, ck, p, pk in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
        ("nation", "n_regionkey", "region", "r_regionkey")))


def _domain_sql(table, col, values):
    vals = ", ".join(f"'{v}'" for v in values)
    return (f"SELECT '{table}' AS model, '{col}' AS column_name, 'accepted_values' AS check_name, "
            f"CAST(COALESCE(SUM(CASE WHEN {col} IS NOT NULL AND {col} NOT IN ({vals}) "
            f"THEN 1 ELSE 0 END), 0) AS BIGINT) AS failures FROM {table}")


def _range_sql(table, col, lo, hi):
    return (f"SELECT '{table}' AS model, '{col}' AS column_name, 'range' AS check_name, "
            f"CAST(COALESCE(SUM(CASE WHEN {col} IS NOT NULL AND ({col} < {lo} OR {col} > {hi}) "
            f"THEN 1 ELSE 0 END), 0) AS BIGINT) AS failures FROM {table}")


ACCEPTED_VALUE_FAILURES = "\nUNION ALL\n".join([
    _domain_sql("orders", "o_orderstatus", ("O", "F")),
    _domain_sql("orders", "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM",
                                              "4-NOT SPECIFIED", "5-LOW")),
    _domain_sql("lineitem", "l_returnflag", ("A", "N", "R")),
    _domain_sql("lineitem", "l_linestatus", ("O", "F")),
    _domain_sql("customer", "c_mktsegment", ("AUTOMOBILE", "BUILDING", "FURNITURE",
                                             "HOUSEHOLD", "MACHINERY")),
])

RANGE_FAILURES = "\nUNION ALL\n".join([
    _range_sql("lineitem", "l_quantity", 1.0, 50.0),
    _range_sql("lineitem", "l_discount", 0.0, 0.1),
    _range_sql("lineitem", "l_tax", 0.0, 0.08),
    _range_sql("orders", "o_totalprice", 0.0, 500000.0),
    _range_sql("part", "p_size", 1, 50),
    _range_sql("customer", "c_acctbal", -999.99, 9999.99),
])

CLASS_THRESHOLDS = f"""
SELECT *, CAST(15.0 AS DOUBLE) AS min_pct, CAST(25.0 AS DOUBLE) AS max_pct,
  pct_of_total >= 15.0 AND pct_of_total <= 25.0 AS within_bounds
FROM ({CLASS_BALANCE}) b"""


# What counts as personal data in text.
TEXT_PATTERNS = (
    ("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"),
    ("phone", "(^|[^0-9A-Za-z])\\+?[0-9][0-9 -]{7,}[0-9]([^0-9A-Za-z]|$)"),
    ("national_id", "(^|[^0-9A-Za-z])[0-9]{9,14}([^0-9A-Za-z]|$)"),
)


def _pattern_sql(model, source, columns) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, 'pii_pattern_{name}' AS check_name, "
        f"COUNT(*) FILTER (WHERE regexp_matches({c}, '{pattern}')) AS failures FROM {source}"
        for c in columns for name, pattern in TEXT_PATTERNS)


def _pii_sql() -> str:
    return with_star(_pattern_sql("mart_dim", "students", (
        "national_id_hashed", "first_name", "last_name", "gender", "is_current")))


COHORT_MEANS = with_star(f"""
SELECT gender, COUNT(*) AS record_count,
  {avg_sql('composite_activity_score', 2)} AS avg_activity_score,
  {avg_sql('bmi', 2)} AS mean_bmi,
  ROUND(SUM(CASE WHEN sleep_adequate THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2)
    AS sleep_adequacy_rate_pct,
  ROUND(SUM(CASE WHEN hydration_adequate THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2)
    AS hydration_rate_pct
FROM star GROUP BY gender""")

AGE_GROUPS = with_star(f"""
, g AS (SELECT *, CASE WHEN CAST(age_derived AS DOUBLE) < 3.0 THEN '1-2'
                       WHEN CAST(age_derived AS DOUBLE) < 5.0 THEN '3-4'
                       ELSE '5+' END AS age_group FROM star)
SELECT age_group, COUNT(*) AS record_count,
  {avg_sql('composite_activity_score', 2)} AS avg_activity_score,
  ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct_of_total
FROM g GROUP BY age_group""")

MONTHLY_COHORT = with_star(f"""
SELECT year, month, gender, COUNT(*) AS record_count,
  {avg_sql('composite_activity_score', 2)} AS avg_activity_score,
  {avg_sql('bmi', 2)} AS avg_bmi,
  CAST(SUM(CASE WHEN sleep_adequate THEN 1 ELSE 0 END) AS BIGINT) AS sleep_adequate_count
FROM star GROUP BY year, month, gender""")

USER_TRAJECTORY = """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(value) AS n_rows,
                  SUM(CAST(value AS DECIMAL(38,9))) AS s
           FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT user_id, day, n_rows,
  ROUND(CAST(s AS DOUBLE) / CAST(n_rows AS DOUBLE), 4) AS day_avg,
  ROUND(CAST(SUM(s) OVER w AS DOUBLE) / CAST(SUM(n_rows) OVER w AS DOUBLE), 4) AS running_avg
FROM d
WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

INCREMENTAL_MERGE = """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'F' ELSE o_orderstatus END
    AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority
FROM orders"""

DRIFT_PSI = """
WITH b AS (SELECT event_type, COUNT(*) AS base_count FROM events
           WHERE ts < TIMESTAMP '2024-01-16' GROUP BY event_type),
     c AS (SELECT event_type, COUNT(*) AS cur_count FROM events
           WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY event_type),
     bs AS (SELECT *, base_count / SUM(base_count) OVER () AS base_share FROM b),
     cs AS (SELECT *, cur_count / SUM(cur_count) OVER () AS cur_share FROM c),
     j AS (SELECT COALESCE(bs.event_type, cs.event_type) AS event_type,
                  CAST(COALESCE(base_count, 0) AS BIGINT) AS base_count,
                  CAST(COALESCE(cur_count, 0) AS BIGINT) AS cur_count,
                  GREATEST(COALESCE(base_share, 0.0), 0.0001) AS b_,
                  GREATEST(COALESCE(cur_share, 0.0), 0.0001) AS c_
           FROM bs FULL OUTER JOIN cs ON bs.event_type IS NOT DISTINCT FROM cs.event_type)
SELECT event_type, base_count, cur_count, ROUND(b_, 6) AS base_share, ROUND(c_, 6) AS cur_share,
  ROUND((c_ - b_) * LN(c_ / b_), 6) AS psi_term
FROM j"""

FRESHNESS = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, MAX(CAST({c} AS DATE)) AS latest_date, "
    f"DATE '2024-02-01' AS as_of, "
    f"CAST(date_diff('day', MAX(CAST({c} AS DATE)), DATE '2024-02-01') AS INTEGER) AS lag_days, "
    f"CAST(30 AS INTEGER) AS max_lag_days, "
    f"date_diff('day', MAX(CAST({c} AS DATE)), DATE '2024-02-01') <= 30 AS fresh FROM {t}"
    for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts")))

STREAM_WEEKLY = """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n_rows,
  CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS value_sum,
  CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_value
FROM events GROUP BY CAST(date_trunc('week', ts) AS DATE), event_type"""

ROLE_VIEW_COLUMNS = (MART_FACT_COLUMNS
                     .replace("student_key, date_key,", "date_key,")
                     .replace("national_id_hashed,", "CAST(NULL AS VARCHAR) AS national_id_hashed,")
                     .replace("age_derived, start_date, end_date,", "age_derived,"))

ORACLE.update({
    "scd_current": f"SELECT * FROM ({STAGE_ORDERS}) s WHERE is_current = 'O'",
    "scd_as_of": SCD_AS_OF,
    "weekly_per_user": WEEKLY_PER_USER,
    "trend_direction": TREND_DIRECTION,
    "stratified_class": with_star(
        f"SELECT {KEYS}, health_condition, bmi_class, composite_activity_score FROM star "
        f"WHERE health_condition = '5-low'"),
    "weekly_active": "SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, "
                     "COUNT(DISTINCT user_id) AS active_entities, COUNT(*) AS n_rows "
                     "FROM events GROUP BY CAST(date_trunc('week', ts) AS DATE)",
    "fk_failures": FK_FAILURES,
    "accepted_value_failures": ACCEPTED_VALUE_FAILURES,
    "range_failures": RANGE_FAILURES,
    "class_thresholds": CLASS_THRESHOLDS,
    "pii_scan": _pii_sql(),
    "cohort_means": COHORT_MEANS,
    "age_groups": AGE_GROUPS,
    "monthly_cohort": MONTHLY_COHORT,
    "user_trajectory": USER_TRAJECTORY,
    "incremental_merge": INCREMENTAL_MERGE,
    "drift_psi": DRIFT_PSI,
    "freshness": FRESHNESS,
    "stream_weekly": STREAM_WEEKLY,
    "role_view": with_star(f"SELECT {ROLE_VIEW_COLUMNS} FROM star WHERE severity_level = 'europe'"),
})

COMPLETENESS_DRIFT = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, "
    f"(SELECT COUNT({c}) / COUNT(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01') "
    f"AS base_complete, "
    f"(SELECT COUNT({c}) / COUNT(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01') "
    f"AS cur_complete"
    for c in ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"))

ORACLE.update({
    "distribution_filtered": f"SELECT * FROM ({METRIC_DISTRIBUTION}) d "
                             f"WHERE health_condition = '1-urgent'",
    "bmi_filtered": f"SELECT * FROM ({METRIC_BMI}) b WHERE gender = 'building' "
                    f"AND bmi_class = 'Obese'",
    "sleep_filtered": f"SELECT * FROM ({METRIC_SLEEP}) s "
                      f"WHERE health_condition = '4-not specified'",
    "serving_verify": with_star(f"""
SELECT 'dim_student_transformed' AS table_name, COUNT(*) AS row_count, TRUE AS present
  FROM students
UNION ALL SELECT 'fact_health_transformed', COUNT(*), TRUE FROM star
UNION ALL SELECT 'mrt_health_distribution', COUNT(*), TRUE FROM (
  SELECT 1 FROM star GROUP BY health_condition, gender, diet_type) g
UNION ALL SELECT 'mrt_missing', CAST(NULL AS BIGINT), FALSE"""),
    "completeness_drift": f"SELECT *, cur_complete - base_complete AS delta "
                          f"FROM ({COMPLETENESS_DRIFT}) c",
})

SCD_HISTORY = f"""
SELECT student_key, o_orderkey, start_date, health_condition,
  lead(start_date) OVER (PARTITION BY student_key ORDER BY start_date, o_orderkey) AS valid_to
FROM ({STAGE_ORDERS}) s"""

ORACLE["scd_history"] = SCD_HISTORY

# ---------------------------------------------------------------- CSV text, history, publishing

ORDERS_WITH_FEATURES = """
owf AS (
  SELECT o.*, s.national_id_hashed, s.age_derived
  FROM orders o LEFT JOIN students s ON s.o_orderkey = o.o_orderkey
)"""
_OWF_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority", "national_id_hashed", "age_derived")
METRIC_TABLES = {"mrt_health_distribution": METRIC_DISTRIBUTION, "mrt_bmi_by_gender": METRIC_BMI,
                 "mrt_sleep_adequacy": METRIC_SLEEP, "mrt_weekly_activity": METRIC_WEEKLY,
                 "mrt_risk_correlations": METRIC_RISK}
FEATURES = """bmi_class, composite_activity_score, health_trend_indicator, sleep_quality_encoded,
  physical_activity_encoded, smoking_alcohol_encoded"""

def _contract_rows(name, named):
    checks = {"file_exists": "TRUE", "file_not_empty": "TRUE", "header_present": "TRUE",
              "required_columns": named, "pii_columns_present": named}
    parts = [f"SELECT '{name}' AS table_name, '{c}' AS check_name, {ok} AS passed, "
             f"CAST(NULL AS BIGINT) AS row_count" for c, ok in checks.items()]
    return parts + [f"SELECT '{name}', 'min_rows', COUNT(*) >= 1, COUNT(*) FROM customer"]


ORACLE.update({
    "csv_contract_checks": "\nUNION ALL\n".join(
        _contract_rows("customer", "TRUE") + _contract_rows("unnamed", "FALSE")
        + ["SELECT 'missing', 'file_exists', FALSE, CAST(NULL AS BIGINT)"]),
    "csv_text_documents": "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, "
                          "nullif(source, '') AS source, n_chars FROM documents",
    "csv_text_pages": "SELECT page_id, nullif(url, '') AS url, nullif(html, '') AS html "
                      "FROM pages",
    "scd_valid_at": f"SELECT * FROM ({SCD_HISTORY}) h WHERE start_date <= DATE '1998-01-01' "
                    f"AND (valid_to IS NULL OR valid_to > DATE '1998-01-01')",
    "deep_page": f"SELECT * FROM ({SCD_HISTORY}) h ORDER BY valid_to ASC NULLS LAST, o_orderkey "
                 f"LIMIT 300 OFFSET 1300",
    "strata": metric_sql(
        ("health_condition", "bmi_class"),
        {"avg_activity_score": avg_sql("composite_activity_score", 2)},
        {"pct_of_total": (), "pct_within_condition": ("health_condition",)}),
    "get_record_full_key": with_star(
        f"SELECT {RECORD_COLUMNS} FROM star WHERE ({KEYS}) IN "
        f"(SELECT ({KEYS}) FROM star WHERE l_orderkey = 7 ORDER BY {KEYS} LIMIT 1)"),
    "published_counts": "SELECT * FROM (\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, TRUE AS present FROM ({sql}) x"
        for t, sql in {**METRIC_TABLES, "fact_health_transformed": MART_FACT,
                       "dim_student_transformed": with_star("SELECT * FROM students")}.items())
        + "\nUNION ALL SELECT 'mrt_missing', CAST(NULL AS BIGINT), FALSE) all_tables",
    "published_fact": with_star(f"SELECT {MART_BOOL_AS_INT} FROM star"),
    "published_risk": METRIC_RISK,
    "feature_sample": with_star(f"SELECT {KEYS}, {FEATURES} FROM star "
                                f"ORDER BY {KEYS}, {FEATURES} LIMIT 3"),
    "metric_sample": f"SELECT * FROM ({METRIC_DISTRIBUTION}) d "
                     f"ORDER BY health_condition, gender, diet_type LIMIT 5",
    "null_profile_found": with_star(f",{ORDERS_WITH_FEATURES}\n" + "\nUNION ALL\n".join(
        f"SELECT 'orders_with_features' AS table_name, '{c}' AS column_name, "
        f"COUNT(*) - COUNT({c}) AS null_count FROM owf" for c in _OWF_COLUMNS)),
    "not_null_found": with_star(f",{ORDERS_WITH_FEATURES}\nSELECT o_orderkey, o_orderstatus "
                                f"FROM owf WHERE national_id_hashed IS NULL"),
    "orphans_found": "SELECT 'lineitem.l_orderkey->current orders.o_orderkey' AS relationship, "
                     "COUNT(*) AS failures FROM lineitem WHERE l_orderkey IS NOT NULL AND "
                     "NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey "
                     "AND upper(trim(o_orderstatus)) = 'O')",
    "range_failures_found": "\nUNION ALL\n".join([
        _range_sql("lineitem", "l_quantity", 5.0, 45.0),
        _range_sql("lineitem", "l_discount", 0.01, 0.09),
        _range_sql("lineitem", "l_tax", 0.01, 0.07),
        _range_sql("customer", "c_acctbal", 0.0, 9000.0)]),
    "pii_scan_text": _pattern_sql("documents", "documents", ("text",)) + "\nUNION ALL\n"
                     + _pattern_sql("pages", "pages", ("html",)),
    "completeness_found": with_star(f",{ORDERS_WITH_FEATURES}\n"
        "SELECT *, cur_complete - base_complete AS delta FROM (" + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, "
            f"(SELECT COUNT({c}) / COUNT(*) FROM owf WHERE o_orderdate < TIMESTAMP '1998-01-01') "
            f"AS base_complete, "
            f"(SELECT COUNT({c}) / COUNT(*) FROM owf WHERE o_orderdate >= TIMESTAMP '1998-01-01') "
            f"AS cur_complete"
            for c in ("o_totalprice", "national_id_hashed", "age_derived")) + ") c"),
})
