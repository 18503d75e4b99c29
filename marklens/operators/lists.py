"""Rosters, narrow lists, risk lists and top-k lists.

Every order ends in the key, so ties come out the same on each run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marklens.functions.scoring import cleaned, is_at_risk, risk_reason
from marklens.spec import (
    AVERAGE,
    DEFAULT_SPEC,
    GRADE,
    REASON,
    STATUS,
    ScorecardSpec,
)


def roster(
    scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC, with_group: bool = True
) -> DataFrame:
    """All records by key; ``with_group=False`` leaves the group column out."""
    group = [spec.group] if with_group else []
    columns = [spec.key, spec.name, *group, *spec.numeric, AVERAGE, GRADE, STATUS]
    return cleaned(scored, spec).select(*columns).orderBy(spec.key)


def attendance_relation(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return cleaned(scored, spec).select(spec.key, spec.name, spec.attendance, AVERAGE, GRADE, spec.hours)


def study_hours_relation(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return cleaned(scored, spec).select(spec.key, spec.name, spec.hours, AVERAGE, GRADE)


def relation_grid(
    scored: DataFrame,
    measure: str,
    step: float,
    average_step: float = 5.0,
    spec: ScorecardSpec = DEFAULT_SPEC,
) -> DataFrame:
    """A relation to the average as a grid: per cell that is not empty the number of
    records and their mean average, however many points there are.

    A cell begins at a multiple of its step. Records without the measure or without
    an average are counted in cells of their own. The mean is taken over hundredths,
    which are whole numbers, and rounded half up.
    """

    def cell(column: str, width: float) -> Column:
        return F.floor(F.col(column) / width) * F.lit(width)

    hundredths = F.round(F.col(AVERAGE) * 100).cast("bigint")
    cells = cleaned(scored, spec).groupBy(
        cell(measure, step).alias(f"{measure}_From"), cell(AVERAGE, average_step).alias("Average_From")
    )
    found = cells.agg(F.count("*").alias("Students"), F.sum(hundredths).alias("total"))
    mean = F.floor((2 * F.col("total") + F.col("Students")) / (2 * F.col("Students"))) / 100
    return found.select(f"{measure}_From", "Average_From", "Students", mean.alias("Mean_Average"))


def low_attendance(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    below = F.col(spec.attendance) < spec.attendance_floor
    return cleaned(df, spec).filter(below).select(spec.key, spec.name, spec.attendance)


def by_study_hours(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return cleaned(df, spec).select(spec.key, spec.name, spec.hours).orderBy(
        F.col(spec.hours).desc_nulls_last(), spec.key
    )


def at_risk(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Records below either threshold, weakest average first."""
    columns = [spec.key, spec.name, spec.attendance, AVERAGE, GRADE, STATUS]
    return cleaned(scored, spec).filter(is_at_risk(spec)).select(*columns).orderBy(*_weakest_first(spec))


def at_risk_reasons(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The same records with the reason in place of the status."""
    columns = [spec.key, spec.name, spec.attendance, AVERAGE, GRADE]
    return (
        cleaned(scored, spec).filter(is_at_risk(spec))
        .select(*columns, risk_reason(spec).alias(REASON))
        .orderBy(*_weakest_first(spec))
    )


def _weakest_first(spec: ScorecardSpec) -> list[Column]:
    return [F.col(AVERAGE).asc_nulls_first(), F.col(spec.key).asc()]


def best_rows(scored: DataFrame, k: int = 5, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The k rows with the highest average; each task keeps only its own k."""
    return scored.orderBy(F.col(AVERAGE).desc_nulls_last(), spec.key).limit(k)


def top_students(
    scored: DataFrame, k: int = 5, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    return best_rows(top_columns(scored, spec), k, spec)


def top_columns(scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return scored.select(spec.key, spec.name, AVERAGE, GRADE, STATUS)


def best_rows_per_subject(
    df: DataFrame, k: int = 3, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """The k rows with the highest mark in each subject, with that mark and its rank.

    Each subject is a top-k of its own, for which a task keeps k rows in a heap.
    One ranking window over all subjects would sort every task's rows first,
    which takes ten times as long. Here the window only numbers the winners.
    """
    df = cleaned(df, spec)
    heads = [
        df.orderBy(F.col(s).desc_nulls_last(), spec.key)
        .limit(k)
        .withColumns({"Subject": F.lit(s), "Mark": F.col(s)})
        for s in spec.subjects
    ]
    best = Window.partitionBy("Subject").orderBy(F.col("Mark").desc_nulls_last(), spec.key)
    rank = F.row_number().over(best).cast("bigint")
    return reduce(DataFrame.unionByName, heads).withColumn("Rank", rank)


def top_per_subject(
    df: DataFrame, k: int = 3, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    rows = df.select(spec.key, spec.name, *spec.subjects)
    return best_rows_per_subject(rows, k, spec).select(
        "Subject", "Rank", spec.key, spec.name, "Mark"
    )
