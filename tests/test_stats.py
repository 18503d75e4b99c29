import numpy as np
import pytest
from pyspark.sql import functions as F

from marklens.functions.scoring import score
from marklens.operators import distributions as dist
from marklens.operators import lists, model, stats
from marklens.plans import views
from marklens.spec import DEFAULT_SPEC
from samples import column, one, record, records, sample


def empty(spark):
    return score(records(spark, []))


def pairs(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_class_statistics(spark):
    assert one(stats.class_statistics(score(sample(spark)))) == {
        "Total_Students": 12,
        "Class_Average": 55.47,
        "Math_Average": 55.08,
        "Science_Average": 55.5,
        "English_Average": 55.83,
        "Passed": 9,
        "Failed": 3,
    }


def test_class_statistics_of_nothing(spark):
    row = one(stats.class_statistics(empty(spark)))
    assert (row["Total_Students"], row["Passed"], row["Failed"]) == (0, 0, 0)
    assert row["Class_Average"] is None


def test_attendance_and_hours(spark):
    assert one(stats.attendance_summary(sample(spark))) == {
        "Average_Attendance": 75.73,
        "High_Attendance": 9,
        "Low_Attendance": 3,
    }
    assert one(stats.study_hours_summary(sample(spark))) == {
        "Average_Hours": 4.79,
        "Maximum_Hours": 8.0,
        "Minimum_Hours": 1.5,
    }


def test_subject_averages(spark):
    long = stats.subject_averages_long(sample(spark))
    assert pairs(long, "Subject", "Average") == [("Math", 55.08), ("Science", 55.5), ("English", 55.83)]
    assert one(stats.subject_averages(sample(spark)))["Science_Average"] == 55.5


def test_kpis(spark):
    assert one(stats.dashboard_kpis(score(sample(spark)))) == {
        "Total_Students": 12,
        "Class_Average": 55.5,
        "Average_Attendance": 75.7,
        "Average_Study_Hours": 4.8,
        "Pass_Rate": 75.0,
    }
    assert one(stats.dashboard_cards(score(sample(spark)))) == {
        "Total_Students": "12",
        "Class_Average": "55.5",
        "Average_Attendance": "75.7%",
        "Average_Study_Hours": "4.8",
        "Pass_Rate": "75.0%",
    }
    assert one(stats.dashboard_kpis(empty(spark)))["Pass_Rate"] == 0.0


def test_distributions(spark):
    scored = score(sample(spark))
    grades = [("A", 1), ("B", 1), ("C", 2), ("D", 2), ("F", 6)]
    assert pairs(dist.grade_distribution(scored), "Grade", "Students") == grades
    assert pairs(dist.grade_distribution_dense(scored), "Grade", "Students") == grades
    assert pairs(dist.status_distribution(scored), "Status", "Students") == [("FAIL", 3), ("PASS", 9)]
    dense = dist.status_distribution_dense(scored)
    assert pairs(dense, "Status", "Students") == [("PASS", 9), ("FAIL", 3)]
    support = dist.support_distribution(model.label_support(scored))
    assert sum(column(support, "Students")) == 12


def test_dense_distributions_keep_empty_values(spark):
    scored = score(records(spark, [record(1)]))
    assert pairs(dist.grade_distribution(scored), "Grade", "Students") == [("F", 1)]
    assert column(dist.grade_distribution_dense(scored), "Students") == [0, 0, 0, 0, 1]
    assert column(dist.grade_distribution_dense(empty(spark)), "Students") == [0] * 5
    assert column(dist.status_distribution_dense(empty(spark)), "Students") == [0, 0]
    assert column(dist.attendance_histogram(empty(spark)), "Students") == [0] * 10


def test_histogram(spark):
    counts = dist.attendance_histogram(sample(spark))
    assert column(counts, "Bin_Start") == list(range(0, 100, 10))
    assert column(counts, "Students") == [0, 0, 0, 0, 0, 1, 2, 5, 3, 1]


def test_histogram_keeps_values_at_and_past_the_ends(spark):
    values = [0.0, -5.0, 100.0, 120.0, 10.0, 9.99, None, float("nan")]
    df = records(spark, [record(i, attendance=v) for i, v in enumerate(values, 1)])
    assert column(dist.attendance_histogram(df), "Students") == [3, 1, 0, 0, 0, 0, 0, 0, 0, 2]


def test_box_quartiles(spark):
    rows = {r.Subject: (r.Q1, r.Median, r.Q3) for r in dist.subject_box(sample(spark)).collect()}
    assert rows == {
        "Math": (37.25, 56.5, 71.25),
        "Science": (39.75, 52.0, 77.5),
        "English": (39.75, 55.5, 70.75),
    }


@pytest.mark.parametrize("bins", [1, 7, 1000])
@pytest.mark.parametrize("rows", [1, 2, 3, 50, 501])
def test_box_against_brute_force(spark, bins, rows):
    rng = np.random.default_rng(rows)
    spread = rng.normal(50, 25, rows)
    same = np.where(rng.random(rows) < 0.4, 33.0, rng.random(rows) * 100)
    whole = rng.integers(0, 101, rows).astype(float)
    df = records(
        spark,
        [record(i + 1, 80.0, 4.0, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(spread, same, whole))],
    )
    got = {r.Subject: r.asDict() for r in dist.subject_box(df, bins=bins).collect()}
    for subject, values in (("Math", spread), ("Science", same), ("English", whole)):
        q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= low - 1e-9) & (values <= high + 1e-9)]
        row = got[subject]
        assert row["Marks"] == rows
        want = [values.min(), q1, q2, q3, values.max(), low, high, inside.min(), inside.max()]
        names = ["Minimum", "Q1", "Median", "Q3", "Maximum", "Lower_Fence", "Upper_Fence", "Lower_Whisker", "Upper_Whisker"]
        assert [row[n] for n in names] == pytest.approx(want)
        assert row["Outliers"] == rows - len(inside)


def test_box_leaves_missing_marks_out(spark):
    rows = [record(1, math=10.0), record(2, math=None), record(3, math=float("nan")), record(4, math=30.0)]
    box = {r.Subject: r for r in dist.subject_box(records(spark, rows)).collect()}
    assert (box["Math"].Marks, box["Math"].Median, box["English"].Marks) == (2, 20.0, 4)


def test_totals_agree(spark):
    scored = score(sample(spark))
    total = scored.count()
    for counts in (
        dist.grade_distribution(scored),
        dist.grade_distribution_dense(scored),
        dist.status_distribution_dense(scored),
        dist.attendance_histogram(scored),
    ):
        assert one(counts.agg(F.sum("Students").alias("n")))["n"] == total


@pytest.mark.parametrize("field", ["attendance", "hours", "math", "science", "english"])
def test_nan_counts_as_missing(spark, field):
    """Every summary, ranking and view gives the same for NaN as for null."""

    def results(gap):
        df = records(spark, [record(1, **{field: gap}), record(2), record(3, attendance=60.0)])
        scored = score(df)
        views.register_view(scored, "gaps")
        reports = [
            stats.class_statistics(scored), stats.subject_averages(df),
            stats.subject_averages_long(df), stats.attendance_summary(df),
            stats.study_hours_summary(df), stats.dashboard_kpis(scored),
            stats.dashboard_cards(scored), lists.by_study_hours(df), lists.top_students(scored),
            lists.top_per_subject(df), lists.at_risk(scored), lists.at_risk_reasons(scored),
            lists.low_attendance(df), lists.roster(scored), lists.attendance_relation(scored),
            lists.study_hours_relation(scored), views.class_summary(spark, "gaps"),
            views.top_students(spark, view="gaps"), views.at_risk_students(spark, view="gaps"),
        ]
        return [[tuple(r) for r in report.collect()] for report in reports]

    assert results(float("nan")) == results(None)


def test_box_cells_follow_the_marks(spark):
    """Marks that all lie within a millionth, and beyond the range, spread over cells."""
    df = spark.range(100_000).select(
        (50 + F.col("id") / 1e11).alias("Math"), (500 + F.col("id") / 10).alias("Science"),
        F.lit(None).cast("double").alias("English"),
    )
    long = dist._long_marks(df, DEFAULT_SPEC, 1000)
    cells = dist._ranked_marks(long, 1000).groupBy("bin", "cell").count()
    assert cells.agg(F.max("count")).first()[0] <= 1000
    box = {r.Subject: r for r in dist.subject_box(df).collect()}
    assert box["Science"].Median == pytest.approx(500 + 99_999 / 20)
    assert box["Math"].Median == pytest.approx(50 + 99_999 / 2e11, abs=1e-12)
