"""One-row summaries; each is a single aggregate, so a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.functions.scoring import cleaned
from marklens.functions.text import fixed, percent
from marklens.spec import AVERAGE, DEFAULT_SPEC, STATUS, ScorecardSpec


def _mean(column: str, digits: int = 2) -> Column:
    return F.round(F.avg(column), digits)


def _subject_means(spec: ScorecardSpec) -> list[Column]:
    return [_mean(s).alias(f"{s}_Average") for s in spec.subjects]


def class_statistics(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Row count, class and subject averages, passes and failures."""
    return cleaned(scored, spec).agg(
        F.count(F.lit(1)).alias("Total_Students"),
        _mean(AVERAGE).alias("Class_Average"),
        *_subject_means(spec),
        F.count_if(F.col(STATUS) == spec.passed).alias("Passed"),
        F.count_if(F.col(STATUS) == spec.failed).alias("Failed"),
    )


def subject_averages(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return cleaned(df, spec).agg(*_subject_means(spec))


def subject_averages_long(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per subject; the unpivot works on the one aggregated row."""
    wide = cleaned(df, spec).agg(*[_mean(s).alias(s) for s in spec.subjects])
    return wide.unpivot([], list(spec.subjects), "Subject", "Average")


def attendance_summary(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    attendance = F.col(spec.attendance)
    return cleaned(df, spec).agg(
        _mean(spec.attendance).alias("Average_Attendance"),
        F.count_if(attendance >= spec.attendance_floor).alias("High_Attendance"),
        F.count_if(attendance < spec.attendance_floor).alias("Low_Attendance"),
    )


def study_hours_summary(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return cleaned(df, spec).agg(
        _mean(spec.hours).alias("Average_Hours"),
        F.max(spec.hours).alias("Maximum_Hours"),
        F.min(spec.hours).alias("Minimum_Hours"),
    )


def dashboard_kpis(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Headline numbers with one decimal; the pass rate of no records is 0."""
    return _kpis(scored, spec).select(
        "Total_Students",
        *[F.round(c, 1).alias(c) for c in _KPI_MEANS],
        F.round("Pass_Rate", 1).alias("Pass_Rate"),
    )


def dashboard_cards(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The headline numbers as display text."""
    kpis = _kpis(scored, spec)
    return kpis.select(
        F.col("Total_Students").cast("string").alias("Total_Students"),
        fixed(F.col("Class_Average"), 1).alias("Class_Average"),
        F.concat(fixed(F.col("Average_Attendance"), 1), F.lit("%")).alias(
            "Average_Attendance"
        ),
        fixed(F.col("Average_Study_Hours"), 1).alias("Average_Study_Hours"),
        percent(F.col("Pass_Rate") / 100, 1).alias("Pass_Rate"),
    )


_KPI_MEANS = ("Class_Average", "Average_Attendance", "Average_Study_Hours")


def _kpis(scored: DataFrame, spec: ScorecardSpec) -> DataFrame:
    total = F.count(F.lit(1))
    passed = F.count_if(F.col(STATUS) == spec.passed)
    return cleaned(scored, spec).agg(
        total.alias("Total_Students"),
        F.avg(AVERAGE).alias("Class_Average"),
        F.avg(spec.attendance).alias("Average_Attendance"),
        F.avg(spec.hours).alias("Average_Study_Hours"),
        F.coalesce(F.try_divide(100.0 * passed, total), F.lit(0.0)).alias("Pass_Rate"),
    )
