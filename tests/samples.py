"""Twelve records with known results, and helpers to read results."""

from __future__ import annotations

from marklens.spec import DEFAULT_SPEC, INGEST_ORDER

# id, attendance, hours, math, science, english
ROWS = [
    (21, 93.0, 6.0, 95.0, 91.0, 97.0),
    (22, 75.0, 3.5, 61.0, 58.0, 64.0),
    (23, 81.5, 5.0, 72.0, 77.0, 70.0),
    (24, 68.0, 6.0, 71.0, 83.0, 59.0),
    (25, 75.0, 2.0, 44.0, 52.0, 41.0),
    (26, 88.25, 7.5, 84.0, 79.0, 86.0),
    (27, 60.0, 4.5, 38.0, 42.0, 47.0),
    (28, 79.0, 4.5, 52.0, 52.0, 52.0),
    (29, 77.0, 5.5, 31.0, 25.0, 36.0),
    (30, 52.0, 1.5, 35.0, 22.0, 18.0),
    (31, 85.0, 8.0, 66.0, 52.0, 73.0),
    (32, 75.0, 3.5, 12.0, 33.0, 27.0),
]

# id -> average, grade, status, support category
EXPECTED = {
    21: (94.33, "A", "PASS", "On track"),
    22: (61.0, "D", "PASS", "On track"),
    23: (73.0, "C", "PASS", "On track"),
    24: (71.0, "C", "PASS", "Moderate support"),
    25: (45.67, "F", "PASS", "Moderate support"),
    26: (83.0, "B", "PASS", "On track"),
    27: (42.33, "F", "PASS", "Moderate support"),
    28: (52.0, "F", "PASS", "Moderate support"),
    29: (30.67, "F", "FAIL", "High support"),
    30: (25.0, "F", "FAIL", "High support"),
    31: (63.67, "D", "PASS", "On track"),
    32: (24.0, "F", "FAIL", "High support"),
}


def record(key, attendance=80.0, hours=4.0, math=50.0, science=50.0, english=50.0, name=None):
    return (key, name or f"Person {key}", "Other", attendance, hours, math, science, english)


def records(spark, rows):
    return spark.createDataFrame(rows, DEFAULT_SPEC.schema)


def sample(spark):
    return records(spark, [record(*row) for row in ROWS])


def submitted(spark, rows):
    """Text rows; each row is a dict of changes to an acceptable submission."""
    fields = dict(
        Student_ID="1",
        Name="Someone",
        Gender="Other",
        Attendance="80",
        Study_Hours="4",
        Math="50",
        Science="50",
        English="50",
    )
    schema = DEFAULT_SPEC.submission_schema.add(INGEST_ORDER, "long")
    data = [
        tuple({**fields, **row}[c] for c in fields) + (row.get(INGEST_ORDER, i),)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, schema)


def one(df):
    (row,) = df.collect()
    return row.asDict()


def column(df, name):
    return [row[name] for row in df.collect()]


def final_plan(df):
    """The physical plan as adaptive execution ended up running it."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
