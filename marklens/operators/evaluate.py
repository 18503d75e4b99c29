"""Evaluation of any table with a label and a prediction column.

All measures come from counts that one global aggregate takes, so a task sends
one row however many records it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.functions.text import percent
from marklens.operators.distributions import dense_counts

METRICS = ("Accuracy", "Precision", "Recall", "F1_Score")


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """Every pair of labels with its count, zeros included."""
    cases = [
        ((a, p), (F.col(actual) == a) & (F.col(predicted) == p)) for a in labels for p in labels
    ]
    return dense_counts(df, ["Actual", "Predicted"], cases, "Samples")


def confusion_matrix_wide(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """One row per actual label and one column per predicted label."""
    cells = [
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"{i}_{j}")
        for i, a in enumerate(labels)
        for j, p in enumerate(labels)
    ]
    rows = [
        F.struct(
            F.lit(a).alias("Actual"),
            *[F.col(f"{i}_{j}").alias(p) for j, p in enumerate(labels)],
        )
        for i, a in enumerate(labels)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where nothing was predicted or nothing is there to be found."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _class_rows(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """Per label its precision, recall, F1 and support, with the overall counts."""
    is_hit = F.col(actual) == F.col(predicted)
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(is_hit).alias("hits")]
    for i, label in enumerate(labels):
        counts += [
            F.count_if(is_hit & (F.col(actual) == label)).alias(f"tp{i}"),
            F.count_if(F.col(predicted) == label).alias(f"predicted{i}"),
            F.count_if(F.col(actual) == label).alias(f"actual{i}"),
        ]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label).alias("Label"),
            F.col(f"tp{i}").alias("tp"),
            F.col(f"predicted{i}").alias("n_predicted"),
            F.col(f"actual{i}").alias("Support"),
        )
        for i, label in enumerate(labels)
    ]
    per_class = df.agg(*counts).select("total", "hits", F.inline(F.array(*rows)))
    tp, found, there = F.col("tp"), F.col("n_predicted"), F.col("Support")
    return per_class.withColumns(
        {
            "Precision": _ratio(tp, found),
            "Recall": _ratio(tp, there),
            "F1_Score": _ratio(2 * tp, found + there),
        }
    )


def evaluation_metrics(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """Accuracy and the plain class means of precision, recall and F1.

    Labels that are neither there nor predicted do not count in the means.
    """
    rows = _class_rows(df, actual, predicted, labels)
    occurs = (F.col("n_predicted") + F.col("Support")) > 0

    def class_mean(column: str) -> Column:
        return F.coalesce(F.avg(F.when(occurs, F.col(column))), F.lit(0.0)).alias(column)

    return rows.agg(
        _ratio(F.max("hits"), F.max("total")).alias("Accuracy"),
        *[class_mean(c) for c in METRICS[1:]],
        F.max("total").alias("Samples"),
    )


def metric_cards(metrics: DataFrame) -> DataFrame:
    """The four measures as percent text."""
    return metrics.select(*[percent(F.col(c)).alias(c) for c in METRICS])


def classification_report(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """Measures per label, then accuracy, plain means and support-weighted means."""
    rows = _class_rows(df, actual, predicted, labels)
    measures = ("Precision", "Recall", "F1_Score")
    support = F.sum("Support")

    def weighted(column: str) -> Column:
        return _ratio(F.sum(F.col(column) * F.col("Support")), support)

    # One row holding the class rows and the three summary rows.
    nothing = F.lit(None).cast("double")
    accuracy = _ratio(F.max("hits"), F.max("total"))
    class_row = F.struct("position", "Label", *measures, "Support")
    folded = rows.agg(
        F.array_sort(F.collect_list(class_row)).alias("c"),
        F.array(
            _summary(len(labels), "accuracy", [nothing, nothing, accuracy], support),
            _summary(len(labels) + 1, "macro avg", [F.avg(m) for m in measures], support),
            _summary(len(labels) + 2, "weighted avg", [weighted(m) for m in measures], support),
        ).alias("s"),
    )
    unfolded = folded.select(F.inline(F.concat("c", "s")))
    return unfolded.select("Label", *measures, "Support")


def _summary(position: int, label: str, measures: list[Column], support: Column) -> Column:
    precision, recall, f1 = measures
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(label).alias("Label"),
        precision.alias("Precision"),
        recall.alias("Recall"),
        f1.alias("F1_Score"),
        support.alias("Support"),
    )
