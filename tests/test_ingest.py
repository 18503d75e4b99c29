import random
from dataclasses import replace

import pytest

from marklens.operators import ingest
from marklens.sources import records as store
from marklens.spec import DEFAULT_SPEC
from samples import column, final_plan, record, records, submitted

MARK_RANGE = "Marks must be between 0 and 100."


def reasons(spark, rows, stored=()):
    base = records(spark, [record(k) for k in stored])
    checked = ingest.validate(submitted(spark, rows), base)
    return [r.Reject_Reason for r in checked.orderBy("Ingest_Order").collect()]


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"Student_ID": "x"}, ingest.NOT_A_NUMBER),
        ({"Student_ID": None}, ingest.NOT_A_NUMBER),
        ({"Student_ID": "0"}, "Student ID must be at least 1."),
        ({"Student_ID": " 42 "}, ingest.DUPLICATE_KEY),
        ({"Student_ID": "0042"}, ingest.DUPLICATE_KEY),
        ({"Student_ID": "42", "Math": "x"}, ingest.DUPLICATE_KEY),
        ({"Math": "x", "Name": " "}, ingest.NOT_A_NUMBER),
        ({"Math": "NaN"}, ingest.NOT_A_NUMBER),
        ({"Study_Hours": ""}, ingest.NOT_A_NUMBER),
        ({"Name": "  ", "Attendance": "101"}, ingest.BLANK_NAME),
        ({"Name": None}, ingest.BLANK_NAME),
        ({"Attendance": "100.01", "Study_Hours": "-1"}, ingest.ATTENDANCE_RANGE),
        ({"Attendance": "-0.1"}, ingest.ATTENDANCE_RANGE),
        ({"Study_Hours": "-0.5", "Math": "101"}, ingest.NEGATIVE_HOURS),
        ({"Study_Hours": "24.5", "Math": "101"}, "Study hours must not exceed 24."),
        ({"Science": "100.5"}, MARK_RANGE),
        ({"English": "-1"}, MARK_RANGE),
        ({"Attendance": "0", "Study_Hours": "24", "Math": "0", "English": "100"}, None),
    ],
)
def test_rules(spark, change, reason):
    assert reasons(spark, [change], stored=[42]) == [reason]


def test_first_acceptable_row_of_a_key_wins(spark):
    rows = [
        {"Student_ID": "7", "Math": "500"},
        {"Student_ID": "7", "Name": "kept"},
        {"Student_ID": "07", "Name": "late"},
        {"Student_ID": " 7", "Math": "x"},
    ]
    dup = ingest.DUPLICATE_KEY
    assert reasons(spark, rows) == [MARK_RANGE, None, dup, dup]


def test_missing_columns_are_blank(spark):
    batch = submitted(spark, [{"Student_ID": "1"}]).drop("Gender")
    (row,) = ingest.validate(batch, records(spark, [])).collect()
    assert (row.Gender, row.Reject_Reason) == ("", None)
    (row,) = ingest.validate(batch.drop("Math"), records(spark, [])).collect()
    assert (row.Math, row.Reject_Reason) == (None, ingest.NOT_A_NUMBER)


def test_without_an_upper_limit_for_hours(spark):
    spec = replace(DEFAULT_SPEC, hours_max=None)
    batch = submitted(spark, [{"Study_Hours": "30"}])
    assert column(ingest.validate(batch, records(spark, []), spec), "Reject_Reason") == [None]
    assert reasons(spark, [{"Study_Hours": "30"}]) == ["Study hours must not exceed 24."]


def test_append_adds_only_new_keys(spark):
    base = records(spark, [record(1), record(2)])
    rows = [{"Student_ID": "2"}, {"Student_ID": "3"}, {"Student_ID": "3"}, {"Student_ID": "x"}]
    result = ingest.append_new(submitted(spark, rows), base)
    assert sorted(column(result, "Student_ID")) == [1, 2, 3]
    assert result.columns == base.columns


def test_key_probes(spark):
    base = records(spark, [record(k) for k in (1, 2, 3)])
    batch = spark.createDataFrame([(2,), (2,), (9,), (9,), (None,)], "Student_ID bigint")
    assert column(ingest.existing_keys(batch, base), "Student_ID") == [2]
    assert column(ingest.new_keys(batch, base), "Student_ID") == [9]


def test_append_to_a_table_twice(spark, tmp_path):
    path = str(tmp_path / "students")
    batch = submitted(
        spark,
        [
            {"Student_ID": " 5 ", "Name": 'a "b" c, d'},
            {"Student_ID": "6"},
            {"Student_ID": "6", "Name": "again"},
            {"Student_ID": "-1"},
        ],
    )
    ingest.append_to(batch, path)
    first = sorted(map(tuple, store.read_records(spark, path).collect()))
    ingest.append_to(batch, path)
    assert sorted(map(tuple, store.read_records(spark, path).collect())) == first
    assert [r[:2] for r in first] == [(5, 'a "b" c, d'), (6, "Someone")]


def one_at_a_time(rows, stored):
    """What adding the rows one after the other does."""
    known, verdicts = set(stored), []
    for row in rows:
        text = row["Student_ID"].strip()
        if not text.lstrip("+-").isdigit():
            verdicts.append(ingest.NOT_A_NUMBER)
        elif int(text) < 1:
            verdicts.append("Student ID must be at least 1.")
        elif int(text) in known:
            verdicts.append(ingest.DUPLICATE_KEY)
        elif not row["Name"].strip():
            verdicts.append(ingest.BLANK_NAME)
        elif float(row["Math"]) > 100:
            verdicts.append(MARK_RANGE)
        else:
            known.add(int(text))
            verdicts.append(None)
    return verdicts


@pytest.mark.parametrize("seed", [1, 3, 1000])
def test_same_as_one_at_a_time(spark, seed):
    """Random batches in which one key holds a third of the rows and many ids are bad."""
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        key = "7" if rng.random() < 0.33 else str(rng.randint(-2, 60))
        rows.append(
            {
                "Student_ID": rng.choice([key, f" {key}", "bad"]),
                "Name": rng.choice(["x", "y", " "]),
                "Math": rng.choice(["50", "120"]),
            }
        )
    stored = range(20, 40)
    assert reasons(spark, rows, stored) == one_at_a_time(rows, stored)


def test_frequent_keys_are_split(spark):
    """Two keys of a third of the rows each: adaptive execution splits both."""
    rows = [
        {"Student_ID": str(key), "Name": f"{i} " + "x" * 40}
        for i, key in enumerate([7, 8, 9] * 1500)
    ]
    rows += [{"Student_ID": str(i)} for i in range(100, 1500)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        batch = submitted(spark, rows).repartition(8)
        checked = ingest.validate(batch, records(spark, [record(9)]))
        assert "skew=true" in final_plan(checked)
        kept = ingest.accepted(checked)
        assert kept.filter("Student_ID IN (7, 8)").count() == 2
        assert kept.count() == 1402
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_optional_rules(spark):
    spec = replace(DEFAULT_SPEC, groups=("F", "Other"), key_min=None)
    rows = [{"Student_ID": "-4"}, {"Student_ID": "0", "Gender": "Zed"}]
    checked = ingest.validate(submitted(spark, rows), records(spark, []), spec)
    reasons_ = [r.Reject_Reason for r in checked.orderBy("Ingest_Order").collect()]
    assert reasons_ == [None, "Gender must be one of F, Other."]
