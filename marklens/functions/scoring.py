"""Averages, grade bands, status, risk reasons and support categories."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.functions.rounding import round_half_up
from marklens.spec import AVERAGE, DEFAULT_SPEC, GRADE, STATUS, ScorecardSpec

# The three risk reasons.
REASON_BOTH = "Low attendance and low marks"
REASON_ATTENDANCE = "Attendance below {floor:g}%"
REASON_AVERAGE = "Average below {floor:g}"


def clean(column: str) -> Column:
    """NaN sorts above every number in Spark, so it would earn the best grade."""
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def cleaned(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The table with NaN read as missing in each numeric column that it has."""
    return df.withColumns({c: clean(c) for c in spec.numeric if c in df.columns})


def raw_mean(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    return reduce(add, [clean(s) for s in spec.subjects]) / len(spec.subjects)


def average(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    return round_half_up(raw_mean(spec), 2)


def grade(spec: ScorecardSpec = DEFAULT_SPEC, column: str = AVERAGE) -> Column:
    value = F.col(column)
    (first_floor, first_label), *rest = spec.bands
    bands = F.when(value >= first_floor, first_label)
    for floor, label in rest:
        bands = bands.when(value >= floor, label)
    return bands.otherwise(spec.lowest_band)


def status(spec: ScorecardSpec = DEFAULT_SPEC, column: str = AVERAGE) -> Column:
    return F.when(F.col(column) >= spec.pass_mark, spec.passed).otherwise(spec.failed)


def score(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Add the rounded average and, from it, the grade and the status.

    A record with a missing mark has no average; it is graded lowest and failed.
    """
    return df.withColumn(AVERAGE, average(spec)).withColumns(
        {GRADE: grade(spec), STATUS: status(spec)}
    )


def is_at_risk(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    return (F.col(spec.attendance) < spec.attendance_floor) | (
        F.col(AVERAGE) < spec.average_floor
    )


def risk_reason(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """Why a record is at risk; meaningful on rows that pass ``is_at_risk``."""
    low_attendance = F.col(spec.attendance) < spec.attendance_floor
    low_average = F.col(AVERAGE) < spec.average_floor
    return (
        F.when(low_attendance & low_average, REASON_BOTH)
        .when(low_attendance, REASON_ATTENDANCE.format(floor=spec.attendance_floor))
        .otherwise(REASON_AVERAGE.format(floor=spec.average_floor))
    )


def support_label(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    rules = spec.support
    high, moderate, on_track = rules.categories
    mean = raw_mean(spec)
    attendance, hours = F.col(spec.attendance), F.col(spec.hours)
    needs_much = (
        (mean < rules.high_mean)
        | (attendance < rules.high_attendance)
        | ((hours < rules.high_hours) & (mean < rules.high_hours_mean))
    )
    needs_some = (
        (mean < rules.moderate_mean)
        | (attendance < rules.moderate_attendance)
        | (hours < rules.moderate_hours)
    )
    return F.when(needs_much, high).when(needs_some, moderate).otherwise(on_track)


def risk_flag_category(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """The two risk thresholds as a category: both low, one low, none low."""
    high, moderate, on_track = spec.support.categories
    low_attendance = F.col(spec.attendance) < spec.attendance_floor
    low_average = F.col(AVERAGE) < spec.average_floor
    return (
        F.when(low_attendance & low_average, high)
        .when(low_attendance | low_average, moderate)
        .otherwise(on_track)
    )
