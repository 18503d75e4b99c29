import random

import pytest

from marklens.operators import evaluate
from samples import one

LABELS = ("High support", "Moderate support", "On track")


def table(spark, rows):
    return spark.createDataFrame(rows, "a string, p string")


def measures(rows, label):
    tp = sum(a == p == label for a, p in rows)
    found = sum(p == label for _, p in rows)
    there = sum(a == label for a, _ in rows)
    precision = tp / found if found else 0.0
    recall = tp / there if there else 0.0
    f1 = 2 * tp / (found + there) if found + there else 0.0
    return precision, recall, f1, there, found


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("used", [1, 2, 3])
def test_against_plain_python(spark, seed, used):
    rng = random.Random(seed)
    rows = [(rng.choice(LABELS[:used]), rng.choice(LABELS[:used])) for _ in range(97)]
    df = table(spark, rows)
    per_class = {label: measures(rows, label) for label in LABELS}
    accuracy = sum(a == p for a, p in rows) / len(rows)

    occurring = [m for m in per_class.values() if m[3] + m[4]]
    got = one(evaluate.evaluation_metrics(df, "a", "p", LABELS))
    assert got["Samples"] == 97
    assert got["Accuracy"] == pytest.approx(accuracy, abs=1e-12)
    for i, name in enumerate(("Precision", "Recall", "F1_Score")):
        want = sum(m[i] for m in occurring) / len(occurring)
        assert got[name] == pytest.approx(want, abs=1e-12)

    report = {r.Label: r for r in evaluate.classification_report(df, "a", "p", LABELS).collect()}
    for label, want in per_class.items():
        row = report[label]
        assert (row.Precision, row.Recall, row.F1_Score) == pytest.approx(want[:3], abs=1e-12)
        assert row.Support == want[3]
    assert report["accuracy"].F1_Score == pytest.approx(accuracy, abs=1e-12)
    macro = sum(m[0] for m in per_class.values()) / 3
    assert report["macro avg"].Precision == pytest.approx(macro, abs=1e-12)
    weighted = sum(m[1] * m[3] for m in per_class.values()) / 97
    assert report["weighted avg"].Recall == pytest.approx(weighted, abs=1e-12)


def test_report_order(spark):
    rows = evaluate.classification_report(table(spark, [(LABELS[0], LABELS[1])]), "a", "p", LABELS).collect()
    assert [r.Label for r in rows] == [*LABELS, "accuracy", "macro avg", "weighted avg"]


def test_matrix_has_all_cells(spark):
    df = table(spark, [(LABELS[0], LABELS[2]), (LABELS[0], LABELS[2])])
    cells = [tuple(r) for r in evaluate.confusion_matrix(df, "a", "p", LABELS).collect()]
    assert len(cells) == 9
    assert cells[2] == (LABELS[0], LABELS[2], 2)
    assert sum(n for _, _, n in cells) == 2
    wide = {r.Actual: r for r in evaluate.confusion_matrix_wide(df, "a", "p", LABELS).collect()}
    assert [wide[LABELS[0]][c] for c in LABELS] == [0, 0, 2]
    assert [wide[LABELS[2]][c] for c in LABELS] == [0, 0, 0]


def test_nothing_to_evaluate(spark):
    empty = table(spark, [])
    assert one(evaluate.evaluation_metrics(empty, "a", "p", LABELS)) == {
        "Accuracy": 0.0, "Precision": 0.0, "Recall": 0.0, "F1_Score": 0.0, "Samples": 0,
    }
    assert len(evaluate.classification_report(empty, "a", "p", LABELS).collect()) == 6


def test_cards(spark):
    df = table(spark, [(LABELS[0], LABELS[0]), (LABELS[1], LABELS[0]), (LABELS[1], LABELS[1])])
    cards = one(evaluate.metric_cards(evaluate.evaluation_metrics(df, "a", "p", LABELS)))
    assert cards["Accuracy"] == "66.67%"


def test_cards_round_once(spark):
    metrics = spark.createDataFrame(
        [(0.12344996, 0.5, 0.5, 0.5)], "Accuracy double, Precision double, Recall double, F1_Score double"
    )
    assert one(evaluate.metric_cards(metrics))["Accuracy"] == "12.34%"
