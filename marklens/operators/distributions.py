"""Counts per value or bin, and box summaries of the marks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import pairwise
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marklens.functions.scoring import clean
from marklens.spec import DEFAULT_SPEC, GRADE, STATUS, SUPPORT, ScorecardSpec

BOX_BINS = 1000
QUARTILES = (("Q1", 0.25), ("Median", 0.5), ("Q3", 0.75))


def distribution(df: DataFrame, column: str, count_name: str = "Students") -> DataFrame:
    """Values that occur, with their counts; combined map-side before the shuffle."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))


def grade_distribution(scored: DataFrame) -> DataFrame:
    return distribution(scored, GRADE).orderBy(GRADE)


def status_distribution(scored: DataFrame) -> DataFrame:
    return distribution(scored, STATUS).orderBy(STATUS)


def support_distribution(labelled: DataFrame) -> DataFrame:
    return distribution(labelled, SUPPORT).orderBy(SUPPORT)


def dense_counts(
    df: DataFrame,
    names: Sequence[str],
    cases: Sequence[tuple[tuple, Column]],
    count_name: str,
) -> DataFrame:
    """Count every case of a fixed list, in its order, zeros included.

    One global aggregate counts all cases; its one row is then unfolded, so a
    task sends one row whatever it read and no join fills the gaps.
    """
    counted = df.agg(
        *[F.count_if(condition).alias(f"n{i}") for i, (_, condition) in enumerate(cases)]
    )
    rows = [
        F.struct(
            *[F.lit(v).alias(n) for n, v in zip(names, values, strict=True)],
            F.col(f"n{i}").alias(count_name),
        )
        for i, (values, _) in enumerate(cases)
    ]
    return counted.select(F.inline(F.array(*rows)))


def grade_distribution_dense(
    scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    cases = [((g,), F.col(GRADE) == g) for g in spec.grades]
    return dense_counts(scored, [GRADE], cases, "Students")


def status_distribution_dense(
    scored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    cases = [((s,), F.col(STATUS) == s) for s in spec.statuses]
    return dense_counts(scored, [STATUS], cases, "Students")


def attendance_histogram(
    df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC, width: int = 10, bins: int = 10
) -> DataFrame:
    """Ten bins of width ten; 100 and anything outside falls in the end bins."""
    value = clean(spec.attendance)
    edges = [width * i for i in range(bins + 1)]
    cases = []
    for low, high in pairwise(edges):
        above = value >= low if low > edges[0] else F.lit(True)
        below = value < high if high < edges[-1] else F.lit(True)
        cases.append(((low, high), value.isNotNull() & above & below))
    return dense_counts(df, ["Bin_Start", "Bin_End"], cases, "Students")


def _long_marks(df: DataFrame, spec: ScorecardSpec, bins: int) -> DataFrame:
    """One row per mark, with the subject's number and the mark's bin.

    Bins are numbered in the order of the marks, and no two subjects share a bin
    number. Marks outside the range belong to the first or the last bin. All but
    the mark are whole numbers, which makes for fast grouping and joining.
    """
    stacked = F.stack(
        F.lit(len(spec.subjects)),
        *[cell for i, s in enumerate(spec.subjects) for cell in (F.lit(i), clean(s))],
    ).alias("subject", "Mark")
    share = (F.col("Mark") - spec.mark_min) / (spec.mark_max - spec.mark_min)
    inside = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    bin_in_subject = (inside * bins).cast("bigint")
    return (
        df.select(stacked)
        .filter(F.col("Mark").isNotNull())
        .withColumn("bin", F.col("subject") * F.lit(bins + 1) + bin_in_subject)
    )


def _wanted_ranks() -> list[Column]:
    """Positions, from 0, of the marks on both sides of each quartile."""
    positions = [(F.col("total") - 1) * p for _, p in QUARTILES]
    return [f(p).cast("bigint") for p in positions for f in (F.floor, F.ceil)]


def _quartile_bins(long: DataFrame) -> DataFrame:
    """Bins that hold a wanted rank, with the count of marks before each bin.

    The counts are taken map-side; a subject has at most ``bins + 1`` of them.
    """
    of_subject = Window.partitionBy("subject")
    earlier = of_subject.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = long.groupBy("subject", "bin").agg(
        F.count(F.lit(1)).alias("bin_n"), F.min("Mark").alias("low"), F.max("Mark").alias("high")
    )
    totals = counts.select(
        "subject",
        "bin",
        "bin_n",
        F.coalesce(F.sum("bin_n").over(earlier), F.lit(0)).alias("before"),
        F.sum("bin_n").over(of_subject).alias("total"),
        F.min("low").over(of_subject).alias("minimum"),
        F.max("high").over(of_subject).alias("maximum"),
        "low",
        "high",
    )
    end = F.col("before") + F.col("bin_n")
    holds_rank = reduce(or_, [(F.col("before") <= r) & (r < end) for r in _wanted_ranks()])
    return totals.filter(holds_rank).drop("subject", "bin_n")


def _ranked_marks(long: DataFrame, cells_per_bin: int) -> DataFrame:
    """Distinct marks of the quartile bins with the running count up to each.

    Equal marks meet map-side. The running count is split into counts per cell
    and a count inside each cell, so it runs in parallel over the cells. Cells cut
    what a bin was seen to hold, from its lowest to its highest mark.
    """
    width = F.col("high") - F.col("low")
    inside_bin = F.when(width > 0, (F.col("Mark") - F.col("low")) / width).otherwise(0.0)
    cell = F.least((inside_bin * cells_per_bin).cast("bigint"), F.lit(cells_per_bin - 1))
    facts = ["subject", "bin", "before", "total", "minimum", "maximum"]
    marks = (
        long.join(F.broadcast(_quartile_bins(long)), "bin")
        .withColumn("cell", cell)
        .groupBy(*facts, "cell", "Mark")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    earlier = (
        Window.partitionBy("bin")
        .orderBy("cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = (
        marks.groupBy("bin", "cell")
        .agg(F.sum("n").alias("cell_n"))
        .select(
            "bin",
            "cell",
            F.coalesce(F.sum("cell_n").over(earlier), F.lit(0)).alias("before_cell"),
        )
    )
    inside = (
        Window.partitionBy("bin", "cell")
        .orderBy("Mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("before") + F.col("before_cell") + F.sum("n").over(inside)
    return marks.join(cells, ["bin", "cell"]).withColumn("upto", upto)


def _quantile(p: float) -> Column:
    """Linear interpolation between the two marks around position (n-1)p."""
    position = (F.col("total") - 1) * p
    low = F.min(F.when(F.col("upto") > F.floor(position), F.col("Mark")))
    high = F.min(F.when(F.col("upto") > F.ceil(position), F.col("Mark")))
    return low + (high - low) * (position - F.floor(position))


def subject_box(
    df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC, bins: int = BOX_BINS
) -> DataFrame:
    """Exact quartiles, fences, whiskers and outlier counts per subject.

    ``percentile`` would gather all distinct marks of a subject in one buffer.
    Instead, one pass counts the marks per bin, one looks at the marks of the
    few bins the quartiles fall in, and one compares marks with the fences. The
    broadcasts have at most six bins and one pair of fences per subject.
    """
    long = _long_marks(df, spec, bins)
    iqr = F.col("Q3") - F.col("Q1")
    box = (
        _ranked_marks(long, bins)
        .groupBy("subject", "total", "minimum", "maximum")
        .agg(*[_quantile(p).alias(name) for name, p in QUARTILES])
        .withColumns(
            {"Lower_Fence": F.col("Q1") - 1.5 * iqr, "Upper_Fence": F.col("Q3") + 1.5 * iqr}
        )
    )
    fences = F.broadcast(box.select("subject", "Lower_Fence", "Upper_Fence"))
    within = F.col("Mark").between(F.col("Lower_Fence"), F.col("Upper_Fence"))
    reach = (
        long.join(fences, "subject")
        .groupBy("subject")
        .agg(
            F.min(F.when(within, F.col("Mark"))).alias("Lower_Whisker"),
            F.max(F.when(within, F.col("Mark"))).alias("Upper_Whisker"),
            F.count_if(~within).alias("Outliers"),
        )
    )
    names = F.array(*[F.lit(s) for s in spec.subjects])
    return box.join(F.broadcast(reach), "subject").select(
        F.element_at(names, F.col("subject") + 1).alias("Subject"),
        F.col("total").alias("Marks"),
        F.col("minimum").alias("Minimum"),
        *[name for name, _ in QUARTILES],
        F.col("maximum").alias("Maximum"),
        "Lower_Fence",
        "Upper_Fence",
        "Lower_Whisker",
        "Upper_Whisker",
        "Outliers",
    )
