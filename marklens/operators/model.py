"""Decision tree over the support categories."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
)
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.functions.advice import suggestions
from marklens.functions.scoring import clean, support_label
from marklens.functions.text import explanation
from marklens.operators import evaluate
from marklens.operators.split import IS_TEST, stratified_split
from marklens.sources import ledger
from marklens.spec import DEFAULT_SPEC, SUPPORT, ScorecardSpec

VECTOR = "features"
LABEL_INDEX = "label_index"
PREDICTED = "Predicted_Category"
WEIGHT = "Weight"

# Fixed value: the remark that goes with the measures.
DATA_NOTE = (
    "Synthetic data: metrics measure reproduction of generated rules, "
    "not validated real-world student outcomes."
)


def label_support(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumn(SUPPORT, support_label(spec))


def is_complete(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """Whether a record has every feature; NaN counts as missing."""
    return reduce(and_, [clean(c).isNotNull() for c in spec.features])


def assemble(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Add the feature vector of every record, with 0 for a missing feature."""
    filled = {f"filled_{c}": F.coalesce(clean(c), F.lit(0.0)) for c in spec.features}
    assembler = VectorAssembler(inputCols=list(filled), outputCol=VECTOR)
    return assembler.transform(df.withColumns(filled)).drop(*filled)


def _categories(spec: ScorecardSpec) -> Column:
    return F.array(*[F.lit(c) for c in spec.support.categories])


def index_labels(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Category position as label; its metadata spares the tree a counting job."""
    values = {"ml_attr": {"type": "nominal", "vals": list(spec.support.categories)}}
    position = F.array_position(_categories(spec), F.col(SUPPORT)) - 1
    return df.withColumn(LABEL_INDEX, position.cast("double")).withMetadata(
        LABEL_INDEX, values
    )


def train(
    labelled: DataFrame,
    spec: ScorecardSpec = DEFAULT_SPEC,
    max_depth: int = 5,
    max_bins: int = 128,
    seed: int = 42,
    weight_col: str | None = None,
) -> DecisionTreeClassificationModel:
    """Fit a tree on the complete records.

    Fitting reads its input once per level of the tree, so it is kept meanwhile; a
    lost part is computed again.
    """
    tree = DecisionTreeClassifier(
        featuresCol=VECTOR,
        labelCol=LABEL_INDEX,
        maxDepth=max_depth,
        maxBins=max_bins,
        impurity="gini",
        seed=seed,
    )
    if weight_col:
        tree = tree.setWeightCol(weight_col)
    rows = index_labels(assemble(labelled.filter(is_complete(spec)), spec), spec)
    weight = [weight_col] if weight_col else []
    rows = rows.select(VECTOR, LABEL_INDEX, *weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return tree.fit(rows)
    finally:
        rows.unpersist()


def class_weights(labelled: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Records and weight per category among the complete records, from one aggregate:
    the weight is such that all categories present count alike. A category without
    records has no row."""
    counts = labelled.filter(is_complete(spec) & F.col(SUPPORT).isin(*spec.support.categories))
    counts = counts.groupBy(SUPPORT).agg(F.count("*").alias("Students"))
    sums = counts.agg(F.sum("Students").alias("all"), F.count("*").alias("classes"))
    weight = F.col("all") / (F.col("classes") * F.col("Students"))
    # One row beside at most one row per category.
    joined = counts.withColumns({c: sums.select(c).scalar() for c in ("all", "classes")})
    return joined.select(SUPPORT, "Students", weight.alias(WEIGHT))


def with_class_weights(labelled: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Add each record's weight; a record that takes no part in training has none."""
    weights = class_weights(labelled, spec).select(SUPPORT, WEIGHT)
    return labelled.join(F.broadcast(weights), SUPPORT, "left").select(*labelled.columns, WEIGHT)


@dataclass(frozen=True)
class HoldOut:
    """A trained tree, the records it learned from, its predictions on the records
    held out, and the incomplete records, which take part in neither."""

    tree: DecisionTreeClassificationModel
    training: DataFrame
    predicted: DataFrame
    left_out: DataFrame


def train_and_hold_out(
    labelled: DataFrame,
    spec: ScorecardSpec = DEFAULT_SPEC,
    share: float = 0.2,
    balanced: bool = False,
    store: str | None = None,
    **tree_options,
) -> HoldOut:
    """Train on all but a stratified share of the complete records, predict that share.

    The split depends on the keys alone, so it is computed again where it is used.
    ``balanced`` weights the categories so that a rare one counts as much as others.
    With a ``store`` folder, a tree that was trained there on the same records and
    with the same options is loaded instead; the records and their split are written
    there and read where they are used, as every job would derive them again.
    """
    categories = spec.support.categories
    if store:
        labelled = _written(labelled, store)
    complete = labelled.filter(is_complete(spec))
    divided = stratified_split(complete, SUPPORT, spec.key, categories, share)
    if store:
        divided = _written(divided, store)
    training = divided.filter(~F.col(IS_TEST)).drop(IS_TEST)
    if store:
        options = {"share": share, "balanced": balanced, **tree_options}
        tree = stored_tree(training, store, spec, balanced, options, **tree_options)
    else:
        tree = _fit(training, spec, balanced, **tree_options)
    held_out = divided.filter(IS_TEST).drop(IS_TEST)
    left_out = labelled.filter(~is_complete(spec))
    return HoldOut(tree, training, predict(tree, held_out, spec), left_out)


def _written(df: DataFrame, store: str) -> DataFrame:
    path = f"{store}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fit(
    training: DataFrame, spec: ScorecardSpec, balanced: bool, **tree_options
) -> DecisionTreeClassificationModel:
    if balanced:
        return train(with_class_weights(training, spec), spec, weight_col=WEIGHT, **tree_options)
    return train(training, spec, **tree_options)


def fingerprint(training: DataFrame, options: dict, spec: ScorecardSpec = DEFAULT_SPEC) -> str:
    """What a tree depends on: the records' keys, features and labels, in any order,
    and the options. One row per task is sent."""
    columns = (spec.key, *spec.features, SUPPORT)
    numbers = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38, 0)") for seed in (1, 2)]
    sums = [F.coalesce(F.sum(x), F.lit(0)).cast("string") for x in numbers]
    found = training.agg(F.count("*").cast("string"), *sums).first()
    text = json.dumps([list(found), columns, sorted(options.items()), repr(spec)])
    return hashlib.sha256(text.encode()).hexdigest()


def stored_tree(
    training: DataFrame,
    store: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
    balanced: bool = False,
    options: dict | None = None,
    **tree_options,
) -> DecisionTreeClassificationModel:
    """The tree for these records from a folder of trees, trained and added if it is
    not there. A tree counts as there once its mark is; of two writers of the same
    tree the first one's stays."""
    spark = training.sparkSession
    options = {"balanced": balanced, **tree_options} if options is None else options
    name = fingerprint(training, options, spec)
    mark = f"{store}/{name}.json"
    if ledger.exists(spark, mark):
        return load(f"{store}/{ledger.read_text(spark, mark)}")
    tree, folder = _fit(training, spec, balanced, **tree_options), f"{name}-{uuid.uuid4().hex}"
    save(tree, f"{store}/{folder}")
    ledger.create_new(spark, mark, folder)
    return tree


def sample_counts(
    labelled: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC, share: float = 0.2
) -> DataFrame:
    """Records to learn from, held out, and left out since a feature is missing."""
    complete = labelled.filter(is_complete(spec))
    divided = stratified_split(complete, SUPPORT, spec.key, spec.support.categories, share)
    counts = divided.agg(
        F.count_if(~F.col(IS_TEST)).alias("Training_Samples"),
        F.count_if(F.col(IS_TEST)).alias("Test_Samples"),
    )
    missing = labelled.agg(F.count_if(~is_complete(spec)).alias("Left_Out"))
    return counts.withColumn("Left_Out", missing.scalar())


def evaluation(hold_out: HoldOut, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The tree's measures on the records held out, with all sample counts."""
    metrics = evaluate.evaluation_metrics(
        hold_out.predicted, SUPPORT, PREDICTED, spec.support.categories
    )
    rows = F.count(F.lit(1))
    return metrics.withColumnRenamed("Samples", "Test_Samples").withColumns(
        {
            "Training_Samples": hold_out.training.agg(rows).scalar(),
            "Left_Out": hold_out.left_out.agg(rows).scalar(),
            "Data_Note": F.lit(DATA_NOTE),
        }
    )


@dataclass(frozen=True)
class TreeReport:
    """What is known of a tree: measures, confusion matrix, report and classes."""

    metrics: DataFrame
    matrix: DataFrame
    report: DataFrame
    classes: tuple[str, ...]


def tree_report(hold_out: HoldOut, spec: ScorecardSpec = DEFAULT_SPEC) -> TreeReport:
    classes = tuple(spec.support.categories)
    columns = (hold_out.predicted, SUPPORT, PREDICTED, classes)
    return TreeReport(
        evaluation(hold_out, spec),
        evaluate.confusion_matrix(*columns),
        evaluate.classification_report(*columns),
        classes,
    )


def save(model: DecisionTreeClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> DecisionTreeClassificationModel:
    return DecisionTreeClassificationModel.load(path)


def predict(
    model: DecisionTreeClassificationModel,
    df: DataFrame,
    spec: ScorecardSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Add the predicted category to every record; null where a feature is missing."""
    position = F.col("prediction").cast("int") + 1
    predicted = model.transform(assemble(df, spec))
    category = F.when(is_complete(spec), F.element_at(_categories(spec), position))
    return predicted.select(*df.columns, category.alias(PREDICTED))


def with_advice(
    predicted: DataFrame, category: str = PREDICTED, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Add the prediction record: category, explanation and suggestions.

    A record without a category has neither explanation nor suggestions.
    """
    known = F.col(category).isNotNull()
    record = F.struct(
        F.col(category).alias("category"),
        F.when(known, explanation(spec)).alias("explanation"),
        F.when(known, suggestions(category, spec)).alias("suggestions"),
    )
    return predicted.withColumn("Prediction", record)


def suggestion_rows(
    labelled: DataFrame, category: str = SUPPORT, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """One row per record and suggestion, positions from 1."""
    listed = labelled.select(
        spec.key, category, F.posexplode(suggestions(category, spec)).alias("p", "Suggestion")
    )
    return listed.select(
        spec.key, category, (F.col("p") + 1).cast("bigint").alias("Position"), "Suggestion"
    )
