"""Sketches against exact ranks, grids against counting, weights and stored trees."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marklens.functions import scoring
from marklens.operators import lists, model, sketches
from marklens.plans.catalogue import LABELS, _core_labelled, _trained
from marklens.spec import SUPPORT
from samples import column, final_plan, one, record, records

SF = "/root/testdata/sf0.01"


def many(spark, n=30_000):
    pick = random.Random(2)
    rows = [
        record(k, hours=float(k % 8), math=min(99.0, abs(pick.gauss(50, 20))), science=float(pick.randrange(3)), english=7.0)
        for k in range(1, n)
    ]
    return records(spark, [*rows, record(n, math=None, science=float("nan"))])


def test_quartiles_are_within_their_bound(spark):
    df = many(spark).cache()
    parts = sketches.mark_sketches(df, F.col("Study_Hours")).cache()
    box = sketches.box_of_sketches(parts)
    errors = sketches.rank_errors(df, box).collect()
    assert {r.Subject for r in errors} == {"Math", "Science", "English"}
    for row in errors:
        assert max(row.Q1_Error, row.Median_Error, row.Q3_Error) <= sketches.RANK_ERROR
    found = {r.Subject: r for r in box.collect()}
    assert found["Math"].Marks == 29_999 and found["English"].Q1 == 7.0
    assert found["Math"].Maximum == df.agg(F.max("Math")).first()[0]
    # Any parts can be merged without the marks.
    some = sketches.box_of_sketches(parts.filter("Part < 4"))
    assert one(some.filter("Subject = 'English'"))["Marks"] == df.filter("Study_Hours < 4").count()


def test_a_wrong_quartile_shows(spark):
    df = many(spark, 2000)
    box = sketches.box_of_sketches(sketches.mark_sketches(df, F.lit(1))).withColumn("Median", F.col("Q3"))
    row = sketches.rank_errors(df, box).filter("Subject = 'Math'").first()
    assert row.Median_Error > 0.2 and row.Q1_Error <= sketches.RANK_ERROR


def test_sketches_take_one_shuffle(spark):
    plan = final_plan(sketches.mark_sketches(many(spark, 500), F.col("Study_Hours")))
    assert plan.count("Exchange hashpartitioning") == 1
    assert sketches.mark_sketches(records(spark, []), F.lit(1)).count() == 0


def test_grid(spark):
    df = scoring.score(records(spark, [record(i, attendance=float(i % 23) * 4.5, math=float(i % 50)) for i in range(1, 400)]
                               + [record(900, attendance=None), record(901, math=None), record(902, attendance=100.0)]))
    cells = defaultdict(list)
    for r in df.collect():
        place = tuple(None if v is None else math.floor(v / 5) * 5.0 for v in (r.Attendance, r.Average))
        cells[place].append(r.Average)
    grid = lists.relation_grid(df, "Attendance", 5.0).collect()
    assert {(r.Attendance_From, r.Average_From): r.Students for r in grid} == {k: len(v) for k, v in cells.items()}
    for r in grid:
        own = [round(a * 100) for a in cells[r.Attendance_From, r.Average_From] if a is not None]
        want = (2 * sum(own) + len(own)) // (2 * len(own)) / 100 if own else None
        assert r.Mean_Average == want


def test_class_weights(spark):
    labelled = model.label_support(records(spark, [record(i) for i in range(1, 10)] + [record(99, math=0.0, science=0.0, english=0.0)]))
    rows = {r[SUPPORT]: (r.Students, r.Weight) for r in model.class_weights(labelled).collect()}
    assert rows == {"Moderate support": (9, 10 / 18), "High support": (1, 5.0)}
    weighted = model.with_class_weights(labelled)
    assert one(weighted.groupBy().agg(F.sum("Weight").alias("w")))["w"] == pytest.approx(10)
    assert model.class_weights(labelled.filter("false")).count() == 0


def test_weights_find_the_rare_class(spark):
    labelled = _core_labelled(spark, SF).cache()
    recall = {}
    for balanced in (False, True):
        hold_out = model.train_and_hold_out(labelled, balanced=balanced)
        report = model.tree_report(hold_out).report
        recall[balanced] = {r.Label: r.Recall for r in report.collect() if r.Label in LABELS}
    assert set(recall[True]) == set(LABELS)
    assert recall[True]["On track"] > 0 and recall[True]["On track"] >= recall[False]["On track"]


def test_trees_are_kept_by_what_they_learned_from(spark, tmp_path, monkeypatch):
    store, fitted, fit = str(tmp_path / "trees"), [], model._fit

    def counted(*args, **options):
        fitted.append(1)
        return fit(*args, **options)

    monkeypatch.setattr(model, "_fit", counted)
    labelled = model.label_support(many(spark, 600)).cache()
    first = model.train_and_hold_out(labelled, store=store)
    again = model.train_and_hold_out(labelled.repartition(3), store=store)
    assert len(fitted) == 1 and first.tree.toDebugString == again.tree.toDebugString
    changed = labelled.withColumn("Math", F.when(F.col("Student_ID") == 5, 1.5).otherwise(F.col("Math")))
    model.train_and_hold_out(changed, store=store)
    model.train_and_hold_out(labelled, store=store, balanced=True)
    model.train_and_hold_out(labelled, store=store, max_depth=2)
    assert len(fitted) == 4
    model.train_and_hold_out(labelled, store=store)
    assert len(fitted) == 4


def test_tree_rows_count_the_tree_s_own_predictions(spark, tmp_path):
    """Matrix and report of the registered queries, counted from stored predictions."""
    from marklens.plans.catalogue import QUERIES

    path = str(tmp_path / "predicted")
    _trained(spark, SF).predicted.select(SUPPORT, model.PREDICTED).write.parquet(path)
    import duckdb

    rows = duckdb.sql(f"SELECT {SUPPORT}, {model.PREDICTED}, count(*) FROM '{path}/*.parquet' GROUP BY ALL").fetchall()
    counts = {(a, p): n for a, p, n in rows}
    matrix = {(r.Actual, r.Predicted): r.Samples for r in QUERIES["tree_matrix"](spark, SF).collect()}
    assert matrix == {(a, p): counts.get((a, p), 0) for a in LABELS for p in LABELS}
    report = {r.Label: r for r in QUERIES["tree_class_report"](spark, SF).collect()}
    for label in LABELS:
        support = sum(n for (a, _), n in counts.items() if a == label)
        assert report[label].Support == support
        assert report[label].Recall == pytest.approx(counts.get((label, label), 0) / support)
    assert sorted(column(QUERIES["tree_evaluation"](spark, SF), "Test_Samples")) == [sum(counts.values())]
