import pytest
from pyspark.sql import functions as F

from marklens.functions import scoring, text
from marklens.functions.advice import HIGH_SUPPORT, ON_TRACK, suggestions
from marklens.functions.rounding import round_half_up
from marklens.operators import model
from samples import EXPECTED, column, one, record, records, sample


def scored_one(spark, **marks):
    return one(scoring.score(records(spark, [record(1, **marks)])))


def test_sample_scores(spark):
    rows = model.label_support(scoring.score(sample(spark))).collect()
    got = {r.Student_ID: (r.Average, r.Grade, r.Status, r.Support_Category) for r in rows}
    assert got == EXPECTED


@pytest.mark.parametrize(
    ("mark", "grade", "status"),
    [
        (90.0, "A", "PASS"),
        (89.99, "B", "PASS"),
        (80.0, "B", "PASS"),
        (70.0, "C", "PASS"),
        (60.0, "D", "PASS"),
        (59.99, "F", "PASS"),
        (40.0, "F", "PASS"),
        (39.99, "F", "FAIL"),
        (0.0, "F", "FAIL"),
    ],
)
def test_band_edges(spark, mark, grade, status):
    row = scored_one(spark, math=mark, science=mark, english=mark)
    assert (row["Grade"], row["Status"]) == (grade, status)


def test_bands_use_the_rounded_average(spark):
    row = scored_one(spark, math=89.985, science=90.0, english=90.0)
    assert (row["Average"], row["Grade"]) == (90.0, "A")


def test_label_uses_the_unrounded_mean(spark):
    df = records(spark, [record(1, math=39.988, science=40.0, english=40.0)])
    row = one(model.label_support(scoring.score(df)))
    assert (row["Average"], row["Status"]) == (40.0, "PASS")
    assert row["Support_Category"] == "High support"


@pytest.mark.parametrize("mark", [None, float("nan")])
def test_missing_mark_fails_without_being_at_risk(spark, mark):
    scored = scoring.score(records(spark, [record(1, attendance=80.0, math=mark)]))
    row = one(scored)
    assert (row["Average"], row["Grade"], row["Status"]) == (None, "F", "FAIL")
    assert scored.filter(scoring.is_at_risk()).count() == 0
    low = scoring.score(records(spark, [record(1, attendance=70.0, math=mark)]))
    assert one(low.filter(scoring.is_at_risk()).select(scoring.risk_reason().alias("r"))) == {
        "r": "Attendance below 75%"
    }


def test_support_rule_edges(spark):
    rows = [
        record(1, attendance=54.9, math=90.0, science=90.0, english=90.0),
        record(2, attendance=55.0, math=90.0, science=90.0, english=90.0),
        record(3, hours=1.9, math=54.0, science=54.0, english=54.0),
        record(4, hours=1.9, math=55.0, science=55.0, english=55.0),
        record(5, hours=3.0, attendance=75.0, math=60.0, science=60.0, english=60.0),
        record(6, hours=2.9, attendance=75.0, math=60.0, science=60.0, english=60.0),
    ]
    labelled = model.label_support(records(spark, rows)).orderBy("Student_ID")
    high, moderate, fine = "High support", "Moderate support", "On track"
    assert column(labelled, "Support_Category") == [high, moderate, high, moderate, fine, moderate]


def test_formatting_follows_python(spark):
    values = [0.05, 0.15, 0.25, 2.675, 74.5, 75.5, 49.95, 99.95, 1234.5, 66.66666, 0.5, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        got = column(df.select(text.fixed(F.col("x"), digits).alias("t")), "t")
        assert got == [f"{v:.{digits}f}" for v in values]
        rounded = column(df.select(text.round_half_even(F.col("x"), digits).alias("t")), "t")
        assert rounded == [round(v, digits) for v in values]
    assert column(df.select(text.percent(F.col("x")).alias("t")), "t")[0] == f"{0.05:.2%}"


def test_explanation_wording(spark):
    df = records(spark, [record(1, attendance=74.5, hours=4.25, math=50.0, science=60.0, english=71.0)])
    got = one(df.select(text.explanation().alias("e")))["e"]
    mean = (50.0 + 60.0 + 71.0) / 3
    assert got.startswith(
        f"Entered marks average: {mean:.1f}/100; attendance: {74.5:.0f}%; "
        f"study time: {4.25:.1f} hours/day. "
    )


def test_unknown_category_gets_on_track_suggestions(spark):
    df = spark.createDataFrame([("High support",), ("whatever",), (None,)], "c string")
    got = column(df.select(suggestions("c").alias("s")), "s")
    assert got == [list(HIGH_SUPPORT), list(ON_TRACK), list(ON_TRACK)]


@pytest.mark.parametrize(
    ("value", "number", "real"),
    [
        (" 101 ", 101, 101.0),
        ("0101", 101, 101.0),
        (" +7 \t", 7, 7.0),
        ("-3", -3, -3.0),
        ("1.5", None, 1.5),
        (".5", None, 0.5),
        ("1e2", None, 100.0),
        ("5d", None, None),
        ("0x10", None, None),
        ("nan", None, None),
        ("inf", None, None),
        ("", None, None),
        (None, None, None),
        ("99999999999999999999", None, 1e20),
    ],
)
def test_text_to_number(spark, value, number, real):
    df = spark.createDataFrame([(value,)], "t string")
    row = one(df.select(text.to_long(F.col("t")).alias("n"), text.to_double(F.col("t")).alias("r")))
    assert (row["n"], row["r"]) == (number, real)


def test_fast_rounding_equals_spark_rounding(spark):
    ids = spark.range(200_000)
    hand_made = [0.0, -0.0, 1.005, 2.675, 0.125, 0.135, -0.125, -1.005, 1e6, 1e15 + 0.3, 1e300]
    hand_made += [float("nan"), float("inf"), float("-inf"), None, 0.005, 0.00499999999, 99.995]
    values = spark.createDataFrame([(v,) for v in hand_made], "x double")
    for column in (
        (F.rand(1) - 0.5) * 200,
        F.floor(F.rand(2) * 100_000) / 1000,  # one in ten a tie
        F.floor(F.rand(3) * 300) / 3,
        F.floor(F.rand(4) * 1e6) / 8,
        F.rand(5) * 1e9,
    ):
        values = values.union(ids.select(column))
    for digits in (0, 1, 2):
        rounded = values.select(
            "x", round_half_up(F.col("x"), digits).alias("fast"), F.round("x", digits).alias("slow")
        )
        assert rounded.filter(~F.col("fast").eqNullSafe(F.col("slow"))).take(5) == []


def test_average_preview_rounds_like_python(spark):
    marks = [(50.0, 50.0, 50.015), (33.0, 33.0, 33.015), (89.985, 90.0, 90.0)]
    df = records(spark, [record(i, 80.0, 4.0, *m) for i, m in enumerate(marks, 1)])
    got = column(df.orderBy("Student_ID").select(text.average_preview().alias("p")), "p")
    assert got == [round((a + b + c) / 3, 2) for a, b, c in marks]
