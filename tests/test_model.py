import math
import random

import pytest
from pyspark.sql import functions as F

from marklens.operators import evaluate, model, split
from marklens.plans.catalogue import LABELS, _core_labelled
from marklens.spec import DEFAULT_SPEC, SUPPORT
from samples import column, one, record, records

SF = "/root/testdata/sf0.01"


def brute_force(df, share):
    """Rank every label by hash in plain Python; totals by largest remainder."""
    rows = df.select("Student_ID", SUPPORT, F.xxhash64("Student_ID").alias("h")).collect()
    sizes = {label: sum(r[SUPPORT] == label for r in rows) for label in LABELS}
    total, n = math.ceil(round(len(rows) * share, 6)), len(rows)
    wanted = {label: size * total // n for label, size in sizes.items()}
    present = [label for label in LABELS if sizes[label]]
    order = sorted(present, key=lambda x: (-(sizes[x] * total % n), LABELS.index(x)))
    for label in order[: total - sum(wanted.values())]:
        wanted[label] += 1
    test = set()
    for label in present:
        ranked = sorted((r.h % 2**64, r.Student_ID) for r in rows if r[SUPPORT] == label)
        test |= {key for _, key in ranked[: wanted[label]]}
    return test


@pytest.mark.parametrize("bits", [1, 4, 16])
@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_is_exact(spark, bits, share):
    rng = random.Random(3)
    rows = [(k, rng.choices(LABELS, [90, 9, 1])[0]) for k in range(1, 701)]
    df = spark.createDataFrame(rows, f"Student_ID bigint, {SUPPORT} string")
    parts = split.stratified_split(df, SUPPORT, "Student_ID", LABELS, share, bits)
    assert parts.count() == 700
    got = set(column(parts.filter(split.IS_TEST), "Student_ID"))
    assert got == brute_force(df, share)


def test_total_of_uneven_classes(spark):
    """Nine rows in three classes at a fifth are two test rows, not three."""
    rows = [(k, LABELS[k % 3]) for k in range(9)]
    df = spark.createDataFrame(rows, f"Student_ID bigint, {SUPPORT} string")
    parts = split.stratified_split(df, SUPPORT, "Student_ID", LABELS, 0.2)
    assert parts.filter(split.IS_TEST).count() == 2


def test_split_leaves_other_labels_in_training(spark):
    df = spark.createDataFrame([(1, "On track"), (2, None), (3, "?")], f"Student_ID bigint, {SUPPORT} string")
    parts = split.stratified_split(df, SUPPORT, "Student_ID", LABELS, 1.0)
    flags = {r.Student_ID: r[split.IS_TEST] for r in parts.collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_split_is_repeatable(spark):
    df = spark.range(1, 500).select(F.col("id").alias("Student_ID"), F.lit("On track").alias(SUPPORT))
    again = df.repartition(5)
    parts = [
        sorted(column(split.stratified_split(d, SUPPORT, "Student_ID", LABELS).filter(split.IS_TEST), "Student_ID"))
        for d in (df, again)
    ]
    assert parts[0] == parts[1]
    assert len(parts[0]) == 100


def test_tree_on_held_out_records(spark):
    hold_out = model.train_and_hold_out(_core_labelled(spark, SF))
    predicted = hold_out.predicted.cache()
    metrics = one(model.evaluation(hold_out))
    assert metrics["Accuracy"] >= 0.80
    assert metrics["Test_Samples"] == predicted.count()
    assert metrics["Training_Samples"] == hold_out.training.count() == 11_794
    assert metrics["Test_Samples"] == 2_949 and metrics["Left_Out"] == 257
    report = model.tree_report(hold_out)
    assert one(report.matrix.agg(F.sum("Samples").alias("n")))["n"] == 2_949
    assert report.classes == tuple(LABELS)
    recall = {r.Label: r.Recall for r in report.report.collect()}
    assert set(LABELS) <= set(recall)
    labels = set(column(predicted.select(model.PREDICTED).distinct(), model.PREDICTED))
    assert labels <= set(LABELS)
    cells = evaluate.confusion_matrix(predicted, SUPPORT, model.PREDICTED, LABELS)
    assert one(cells.agg(F.sum("Samples").alias("n")))["n"] == predicted.count()
    advised = model.with_advice(predicted).select("Prediction.*", model.PREDICTED)
    row = advised.first()
    assert row.category == row[model.PREDICTED]
    assert len(row.suggestions) == 3
    assert row.explanation.startswith("Entered marks average: ")


def test_deeper_tree_finds_the_rare_class(spark):
    labelled = _core_labelled(spark, SF).cache()
    recall = {}
    for depth in (5, 8):
        tree = model.train(labelled, max_depth=depth)
        assert tree.depth <= depth
        report = evaluate.classification_report(
            model.predict(tree, labelled), SUPPORT, model.PREDICTED, LABELS
        )
        recall[depth] = {r.Label: r.Recall for r in report.collect()}["On track"]
    assert recall[8] > recall[5]


def test_save_and_load(spark, tmp_path):
    labelled = _core_labelled(spark, "/root/testdata/sf0.001").cache()
    tree = model.train(labelled)
    model.save(tree, str(tmp_path / "tree"))
    back = model.load(str(tmp_path / "tree"))
    differ = model.predict(tree, labelled).exceptAll(model.predict(back, labelled))
    assert differ.count() == 0


@pytest.mark.parametrize("gap", [None, float("nan")])
def test_incomplete_records_stay_without_a_category(spark, gap):
    rows = [record(k, attendance=float(40 + k), math=float(k)) for k in range(1, 60)]
    tree = model.train(model.label_support(records(spark, [*rows, record(99, math=gap)])))
    df = records(spark, [record(1), record(2, math=gap)])
    advised = {r.Student_ID: r for r in model.with_advice(model.predict(tree, df)).collect()}
    assert advised[1][model.PREDICTED] and advised[1].Prediction.suggestions
    assert advised[2][model.PREDICTED] is None and advised[2].Prediction.explanation is None


def test_suggestion_rows(spark):
    df = model.label_support(records(spark, [record(1), record(2, math=0.0, science=0.0, english=0.0)]))
    rows = model.suggestion_rows(df).orderBy("Student_ID", "Position").collect()
    assert [(r.Student_ID, r.Position) for r in rows] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]
    assert rows[3].Suggestion.startswith("Review the topics")
    assert DEFAULT_SPEC.support.categories[0] == rows[3][SUPPORT]


def test_records_are_derived_once_for_a_stored_tree(spark, tmp_path):
    """What is known of the tree comes from the rows written beside it."""
    store = str(tmp_path / "trees")
    labelled = _core_labelled(spark, SF)
    hold_out = model.train_and_hold_out(labelled, store=store, balanced=True)
    for rows in (hold_out.training, hold_out.predicted, hold_out.left_out):
        files = rows.inputFiles()
        assert files and all(store in f for f in files)
    plain = model.train_and_hold_out(labelled, balanced=True)
    assert plain.training.exceptAll(hold_out.training).isEmpty()
    assert hold_out.training.count() == plain.training.count()
    assert hold_out.predicted.count() == plain.predicted.count()
