"""The record view and the reports written in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marklens.functions.scoring import cleaned
from marklens.spec import AVERAGE, DEFAULT_SPEC, GRADE, STATUS, ScorecardSpec

VIEW = "students"


def register_view(
    scored: DataFrame, name: str = VIEW, spec: ScorecardSpec = DEFAULT_SPEC
) -> None:
    cleaned(scored, spec).createOrReplaceTempView(name)


def class_summary(
    spark: SparkSession, view: str = VIEW, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    return spark.sql(f"""
        SELECT count(*) AS Total_Students,
               round(avg({AVERAGE}), 2) AS Class_Average,
               round(avg({spec.attendance}), 2) AS Average_Attendance,
               round(avg({spec.hours}), 2) AS Average_Study_Hours
        FROM {view}
    """)


def top_students(
    spark: SparkSession, k: int = 5, view: str = VIEW, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    return spark.sql(f"""
        SELECT {spec.key}, {spec.name}, {AVERAGE}, {GRADE}, {STATUS}
        FROM {view}
        ORDER BY {AVERAGE} DESC NULLS LAST, {spec.key}
        LIMIT {int(k)}
    """)


def at_risk_students(
    spark: SparkSession, view: str = VIEW, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    return spark.sql(f"""
        SELECT {spec.key}, {spec.name}, {spec.attendance}, {AVERAGE}, {GRADE}, {STATUS}
        FROM {view}
        WHERE {spec.attendance} < {spec.attendance_floor} OR {AVERAGE} < {spec.average_floor}
        ORDER BY {AVERAGE} ASC NULLS FIRST, {spec.key}
    """)
