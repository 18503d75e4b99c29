import os
from pathlib import Path

import pytest

from marklens.functions.scoring import score
from marklens.operators import ingest
from marklens.sources import records as store
from marklens.spec import DEFAULT_SPEC
from samples import ROWS, column, one, record, records, sample, submitted

HEADER = "Student_ID,Name,Gender,Attendance,Study_Hours,Math,Science,English"


def write(tmp_path, *lines, newline="\r\n"):
    path = tmp_path / "students.csv"
    path.write_bytes(newline.join([HEADER, *lines, ""]).encode())
    return str(path)


def test_read_with_windows_line_ends(spark, tmp_path):
    path = write(tmp_path, "41,Some One,X,83.5,6.5,71.0,64.0,92.0", "42,Other,Y,61,2,48,55,39")
    df = store.read_records(spark, path)
    assert df.dtypes[0] == ("Student_ID", "bigint")
    assert [tuple(r) for r in df.collect()] == [
        (41, "Some One", "X", 83.5, 6.5, 71.0, 64.0, 92.0),
        (42, "Other", "Y", 61.0, 2.0, 48.0, 55.0, 39.0),
    ]


def test_one_bad_value_does_not_change_the_types(spark, tmp_path):
    path = write(tmp_path, "1,A,F,80,4,oops,50,50", "2,B,F,80,4,,50,50", "3,C,F,80,4,50,50,50")
    rows = {r.Student_ID: r for r in store.read_records(spark, path, keep_corrupt=True).collect()}
    assert [rows[i].Math for i in (1, 2, 3)] == [None, None, 50.0]
    assert "oops" in rows[1]._corrupt_record
    assert rows[3]._corrupt_record is None


def test_quotes_survive(spark, tmp_path):
    names = ['a "b" c, d', "back\\slash", '"', "é ü 漢字", " padded "]
    df = records(spark, [record(i, name=n) for i, n in enumerate(names, 1)])
    path = str(tmp_path / "table")
    store.append(df, path)
    back = store.read_records(spark, path).orderBy("Student_ID")
    assert column(back, "Name")[:4] == names[:4]


def test_python_csv_is_read(spark, tmp_path):
    import csv

    path = tmp_path / "students.csv"
    with path.open("w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(HEADER.split(","))
        writer.writerow([1, 'a "b", c', "Other", 80.0, 4.0, 1.0, 2.0, 3.0])
    assert one(store.read_records(spark, str(path)))["Name"] == 'a "b", c'


def test_create_empty_once(spark, tmp_path):
    path = str(tmp_path / "table")
    store.create_empty(spark, path)
    assert not store.has_rows(store.read_records(spark, path))
    headers = [f.read_text().strip() for f in Path(path).glob("part-*")]
    assert headers == [HEADER]
    store.append(sample(spark), path)
    store.create_empty(spark, path)
    assert store.read_records(spark, path).count() == len(ROWS)


def test_export_round_trip(spark, tmp_path):
    scored = score(sample(spark))
    path = str(tmp_path / "out")
    store.export(scored, path)
    schema = scored.select(*DEFAULT_SPEC.columns, "Average", "Grade", "Status").schema
    back = spark.read.option("header", True).schema(schema).csv(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, scored.collect()))


def test_export_keeps_the_order(spark, tmp_path):
    scored = score(sample(spark)).coalesce(1)
    path = str(tmp_path / "out")
    store.export(scored, path)
    back = spark.read.option("header", True).csv(path)
    assert column(back, "Student_ID") == [str(i) for i in column(scored, "Student_ID")]


def test_submissions_are_numbered(spark, tmp_path):
    df = store.read_submissions(spark, write(tmp_path, " 1 ,A,F,x,4,5,5,5", "2,B,F,80,4,5,5,5"))
    assert column(df, "Student_ID") == [" 1 ", "2"]
    order = column(df, "Ingest_Order")
    assert order == sorted(set(order))


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "students.csv"
    path.write_text("Student_ID,Extra,English,Science,Math,Attendance\n1,x,50,60,NaN,80\n")
    row = one(store.read_records(spark, str(path)))
    assert (row["English"], row["Science"], row["Math"], row["Attendance"]) == (50.0, 60.0, None, 80.0)
    assert row["Name"] is None and row["Study_Hours"] is None
    assert list(row) == [f.name for f in DEFAULT_SPEC.schema]


def test_files_with_different_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "table"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{HEADER}\n1,A,F,80,4,50,50,50\n")
    (folder / "b.csv").write_text(f"{HEADER.replace('Math,Science', 'Science,Math')}\n2,B,F,80,4,50,50,50\n")
    with pytest.raises(Exception, match="(?i)header"):
        store.read_records(spark, str(folder)).collect()


def test_a_submission_without_a_column_is_parsed_by_name(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Name,Student_ID,Attendance,Study_Hours,Science,Math,English\nAnn,7,80,4,61,62,63\n")
    parsed = ingest.parse(store.read_submissions(spark, str(path)))
    row = one(parsed)
    assert (row["Student_ID"], row["Gender"], row["Science"], row["Math"]) == (7, "", 61.0, 62.0)


def test_order_is_that_of_arrival(spark, tmp_path):
    """A small early file goes before a large late one, whatever Spark reads first."""
    folder = tmp_path / "in"
    folder.mkdir()
    early, late = folder / "z.csv", folder / "a.csv"
    early.write_text(f"{HEADER}\n5,Early,F,80,4,50,50,50\n")
    lines = [f"{i},Late {i},F,80,4,50,50,50" for i in range(1, 2000)]
    late.write_text("\n".join([HEADER, *lines, ""]))
    os.utime(early, (1_600_000_000, 1_600_000_000))
    os.utime(late, (1_700_000_000, 1_700_000_000))
    orders = []
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            batch = store.read_submissions(spark, str(folder))
            rows = batch.orderBy("Ingest_Order").select("Name").collect()
            orders.append([r.Name for r in rows])
            fresh = ingest.accepted(ingest.validate(batch, records(spark, [])))
            assert one(fresh.filter("Student_ID = 5"))["Name"] == "Early"
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert orders[0] == orders[1] == ["Early", *[f"Late {i}" for i in range(1, 2000)]]


def test_another_storage_format(spark, tmp_path):
    path = str(tmp_path / "table")
    batch = submitted(spark, [{"Student_ID": "1"}, {"Student_ID": "2", "Name": " "}])
    ingest.append_to(batch, path, storage="parquet")
    ingest.append_to(batch, path, storage="parquet")
    assert column(store.read_records(spark, path, storage="parquet"), "Student_ID") == [1]
