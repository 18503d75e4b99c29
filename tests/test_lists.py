import pytest

from marklens.functions.scoring import score
from marklens.operators import lists, search
from marklens.plans import views
from marklens.sources.records import has_rows
from samples import column, one, record, records, sample


def ids(df):
    return column(df, "Student_ID")


def test_rosters(spark):
    scored = score(sample(spark))
    full, short = lists.roster(scored), lists.roster(scored, with_group=False)
    assert ids(full) == sorted(ids(scored))
    assert full.columns == [
        "Student_ID", "Name", "Gender", "Attendance", "Study_Hours",
        "Math", "Science", "English", "Average", "Grade", "Status",
    ]
    assert short.columns == [c for c in full.columns if c != "Gender"]


def test_at_risk(spark):
    scored = score(sample(spark))
    expected = [32, 30, 29, 27, 25, 24]
    assert ids(lists.at_risk(scored)) == expected
    reasons = lists.at_risk_reasons(scored)
    assert ids(reasons) == expected
    both, low = "Low attendance and low marks", "Average below 50"
    assert column(reasons, "Reason") == [low, both, low, both, low, "Attendance below 75%"]
    assert reasons.columns == ["Student_ID", "Name", "Attendance", "Average", "Grade", "Reason"]
    views.register_view(scored)
    assert ids(views.at_risk_students(spark)) == expected


def test_at_risk_lists_missing_averages_first(spark):
    rows = [record(1, attendance=60.0), record(2, attendance=60.0, math=None), record(3)]
    assert ids(lists.at_risk(score(records(spark, rows)))) == [2, 1]


def test_nobody_at_risk(spark):
    assert not has_rows(lists.at_risk(score(records(spark, [record(1)]))))
    assert has_rows(lists.at_risk(score(sample(spark))))


def test_top_students(spark):
    scored = score(sample(spark))
    best = [21, 26, 23, 24, 31]
    assert ids(lists.top_students(scored)) == best
    views.register_view(scored)
    assert ids(views.top_students(spark)) == best
    assert lists.top_students(scored).columns == views.top_students(spark).columns
    assert ids(lists.top_students(scored, k=2)) == best[:2]


def test_missing_average_ranks_last(spark):
    rows = [record(1, math=None), record(2, math=0.0, science=0.0, english=0.0)]
    assert ids(lists.top_students(score(records(spark, rows)))) == [2, 1]


def test_top_per_subject(spark):
    rows = lists.top_per_subject(sample(spark)).collect()
    got = {s: [r.Student_ID for r in sorted(rows, key=lambda r: r.Rank) if r.Subject == s] for s in ("Math", "Science", "English")}
    assert got == {"Math": [21, 26, 23], "Science": [21, 24, 26], "English": [21, 26, 31]}


def test_study_hours_order(spark):
    assert ids(lists.by_study_hours(sample(spark))) == [31, 26, 21, 24, 29, 23, 27, 28, 22, 32, 25, 30]


def test_narrow_lists(spark):
    scored = score(sample(spark))
    assert sorted(ids(lists.low_attendance(scored))) == [24, 27, 30]
    relation = lists.attendance_relation(scored)
    assert relation.columns == ["Student_ID", "Name", "Attendance", "Average", "Grade", "Study_Hours"]
    assert lists.study_hours_relation(scored).count() == 12


def test_class_summary_sql(spark):
    views.register_view(score(sample(spark)), "some_class")
    assert one(views.class_summary(spark, "some_class")) == {
        "Total_Students": 12,
        "Class_Average": 55.47,
        "Average_Attendance": 75.73,
        "Average_Study_Hours": 4.79,
    }


def test_find(spark):
    scored = score(sample(spark))
    assert one(search.find_by_key(scored, 21))["Grade"] == "A"
    assert not has_rows(search.find_by_key(scored, 999))
    keys = spark.createDataFrame([(21,), (21,), (26,), (5,), (None,)], "Student_ID bigint")
    assert sorted(ids(search.find_by_keys(scored, keys))) == [21, 26]


@pytest.mark.parametrize(
    ("query", "literal", "expected"),
    [
        ("ann", False, [1, 2]),
        ("^ann", False, [1]),
        ("7", False, [17, 27]),
        ("^17$", False, [17]),
        ("a.n", False, [1, 2, 27]),
        ("a.n", True, [27]),
        ("ÉL", False, [17]),
        ("éL", True, [17]),
        ("   ", False, [1, 2, 17, 27]),
        ("  ann", False, []),
        ("(", True, [2]),
    ],
)
def test_search(spark, query, literal, expected):
    rows = [
        record(1, name="Anne"),
        record(2, name="JoANN (x)"),
        record(17, name="Élodie"),
        record(27, name="a.N."),
    ]
    found = search.search(records(spark, rows), query, literal)
    assert sorted(ids(found)) == expected


def test_search_never_matches_a_missing_name(spark):
    rows = [(5, None, "Other", 80.0, 4.0, 50.0, 50.0, 50.0)]
    assert ids(search.search(records(spark, rows), "none|null")) == []
    assert ids(search.search(records(spark, rows), "5")) == [5]
