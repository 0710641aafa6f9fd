from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.session import build_session  # noqa: E402

NBSP = " "

# A tiny health star as CSV text, with the edge rows the models must handle.
FIXTURE_CSV = {
    "DIM_STUDENT.csv": (
        "﻿student_key,National_ID,First_Name,Last_Name,Gender,Age,Date_of_birth,"
        "Start_date,End_date,Is_current\n"
        "1,00123,Ann,Lee, Female ,20.5,2000-12-31,2020-1-5,,YES\n"
        "2,00456,Bob,Ray,male,20.5,,2020/01/05,NULL,yes\n"
        "3,00456,Cy,Dee,other,21.5,NULL,2020,,YES\n"
        "4,,Di,Fox,female,30,1990-05-05,2019-01-01,2020-01-01, no \n"
        "5,00789,\"Eve, Jr\",Ng,male,25,1999-02-30,2020-01-05Tx,20-01-05,YES\n"
    ),
    "DIM_HEALTH.csv": (
        "health_key,Health_Condition,Typical_Severity_Level,General_Treatment_Type\n"
        "1, Fit ,Low,Medication\n"
        f"2,At-Risk,medium,{NBSP}Therapy{NBSP}\n"
        "3,unhealthy,High,\tRest\n"
    ),
    "DIM_LIFESTYLE.csv": (
        "lifestyle_key,Diet_Type,Smoking_Alcohol,Physical_Activity_Level\n"
        "1,Veg,No,Sedentary\n"
        "2,non-veg,occasional,moderate\n"
        "3,balanced,yes,active\n"
        "4,keto,sometimes,extreme\n"
    ),
    "DIM_ACTIVITY.csv": "activity_key,Activity_Type\n1,Cycling\n2, Yoga \n3,Running\n",
    "DIM_SLEEP.csv": "sleep_key,Sleep_Quality\n1,Poor\n2,average\n3,GOOD\n",
    "DIM_DATE.csv": (
        "date_key,full_date,day_of_week,month,year\n"
        "1,2024-01-07,Sunday,1,2024\n"
        "2,2024-01-08,Monday,1,2024\n"
        "3,2024-01-28,Sunday,1,2024\n"
        "4,2024-01-29,Monday,1,2024\n"
        "5,2024-01-31,Wednesday,1,2024\n"
        "6,NULL,Monday,2,2024\n"
    ),
    "FACT_HEALTH_ANALYTICS.csv": (
        "fact_id,student_key,lifestyle_key,health_key,activity_key,sleep_key,date_key,bmi,"
        "heart_rate,stress_level,sleep_duration,step_count,exercise_duration,"
        "calorie_expenditure,water_intake\n"
        "1,1,1,1,1,1,1,18.5,72.5,3,7.0,14999,120,3901,2.0\n"
        "2,2,2,2,2,2,2,25.0,73.5,2.5,6.5,1000,0,1200,1.5\n"
        "3,3,3,3,3,3,3,30.0,60,4,8,,,,\n"
        "4,4,1,1,1,1,1,20,70,3,7,5000,30,2000,2\n"
        "5,99,1,1,1,1,1,20,70,3,7,5000,30,2000,2\n"
        "6,1,4,1,1,1,4,22,80,5,7.5,0,120,3901,2.5\n"
        "7,2,1,2,3,2,5,17,55,1,9,8000,60,2500,3\n"
        "8,5,2,3,2,3,6,33,90,3,5,3000,10,1500,1\n"
    ),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def fixture_dir(tmp_path):
    src = tmp_path / "source"
    src.mkdir()
    for name, text in FIXTURE_CSV.items():
        (src / name).write_text(text, encoding="utf-8")
    return str(src)


def rows(df, *cols):
    """Collect a small result as a list of tuples, ordered by all columns."""
    cols = cols or tuple(df.columns)
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]
