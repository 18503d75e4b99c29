"""Registered queries over the order tables.

Each takes a session and a table folder and returns a DataFrame. Queries that
print no name start from the core records and so never touch the customers;
top-k queries rank the core records and name only the winners.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marklens.functions import scoring
from marklens.functions.text import average_preview, explanation
from marklens.operators import distributions as dist
from marklens.operators import (
    evaluate,
    ingest,
    lists,
    model,
    search,
    sketches,
    split,
    stats,
    text_index,
)
from marklens.plans import views
from marklens.sources import ledger
from marklens.sources import records as store
from marklens.sources import warehouse as wh
from marklens.sources.workspace import workspace
from marklens.streaming import submissions as stream
from marklens.spec import AVERAGE, GRADE, INGEST_ORDER, STATUS, SUPPORT
from marklens.spec import DEFAULT_SPEC as SPEC

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_KEY = 7
SEARCH_PATTERN = "er#0+1[0-9]*7$"
SEARCH_TEXT = "CUSTOMER#00000001"
LABELS = SPEC.support.categories
FLAG = "Flag_Category"
STREAM_FILES = 3

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _core_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(wh.core_records(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(wh.records(spark, sf_dir))


def _core_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.label_support(wh.core_records(spark, sf_dir)).drop(wh.CUSTOMER_KEY)


# Records and storage


@query
def scan_base(spark, sf_dir):
    return wh.records(spark, sf_dir)


@query
def existing_keys(spark, sf_dir):
    return ingest.existing_keys(wh.line_keys(spark, sf_dir), wh.stored_keys(spark, sf_dir))


@query
def new_keys(spark, sf_dir):
    return ingest.new_keys(wh.line_keys(spark, sf_dir), wh.stored_keys(spark, sf_dir))


@query
def append_new(spark, sf_dir):
    return ingest.append_new(wh.submissions(spark, sf_dir), wh.stored_records(spark, sf_dir))


@query
def validate_rejects(spark, sf_dir):
    incoming, stored = wh.submissions(spark, sf_dir), wh.stored_keys(spark, sf_dir)
    return ingest.rejected(ingest.validate(incoming, stored))


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def _ledger_of(records: DataFrame, name: str) -> str:
    """A table in versions whose first one holds these records."""
    spark = records.sparkSession
    path = _new_folder(spark, name)
    first = ledger.write_folder(records, path)
    ledger.commit(spark, path, ledger.Version().after(first, None, None))
    return path


@query
def scan_csv(spark, sf_dir):
    """The records by way of the CSV table."""
    path = _new_folder(spark, "csv")
    store.append(wh.records(spark, sf_dir), path)
    return store.read_records(spark, path)


@query
def validate_without_marks(spark, sf_dir):
    """A batch that lacks a column: it reads as blank, so no row has that number."""
    incoming = wh.submissions(spark, sf_dir).drop(SPEC.subjects[0])
    return ingest.rejected(ingest.validate(incoming, wh.stored_keys(spark, sf_dir)))


@query
def append_committed(spark, sf_dir):
    """The submissions in two batches, the later half second, committed one by one."""
    incoming = wh.submissions(spark, sf_dir)
    path = _ledger_of(wh.stored_records(spark, sf_dir), "ledger")
    half = incoming.agg(F.floor(F.avg(INGEST_ORDER)).alias("half")).first()["half"] or 0
    for part in (F.col(INGEST_ORDER) <= half, F.col(INGEST_ORDER) > half):
        ingest.append_committed(incoming.filter(part), path)
    return ledger.read(spark, path)


@query
def append_streamed(spark, sf_dir):
    """The submissions as a stream of files; the rows carry their order themselves."""
    inbox = _new_folder(spark, "inbox")
    incoming = wh.submissions(spark, sf_dir).select(*SPEC.columns, INGEST_ORDER)
    ordered = incoming.repartitionByRange(STREAM_FILES, INGEST_ORDER)
    ordered.write.option("header", True).option("escape", '"').csv(inbox)
    path = _ledger_of(wh.stored_records(spark, sf_dir), "ledger")
    arriving = stream.read_stream(spark, inbox)
    stream.append_stream(arriving, path, _new_folder(spark, "checkpoint"), "inbox").awaitTermination()
    return ledger.read(spark, path)


@query
def existing_keys_sorted(spark, sf_dir):
    """Looked up in a table whose files are sorted by key."""
    path = _ledger_of(wh.stored_records(spark, sf_dir), "ledger")
    return ingest.existing_in_ranges(wh.line_keys(spark, sf_dir), path)


# Scores and lists


@query
def score(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def average_previews(spark, sf_dir):
    core = wh.core_records(spark, sf_dir)
    return core.select(SPEC.key, average_preview().alias("Preview"))


@query
def roster_cli(spark, sf_dir):
    return lists.roster(_scored(spark, sf_dir), with_group=False)


@query
def roster_ui(spark, sf_dir):
    return lists.roster(_scored(spark, sf_dir))


@query
def find_by_id(spark, sf_dir):
    found = search.find_by_key(_core_scored(spark, sf_dir), LOOKUP_KEY)
    named = wh.name_few(found, wh.identities(spark, sf_dir))
    return named.select(*SPEC.columns, AVERAGE, GRADE, STATUS)


@query
def find_by_ids(spark, sf_dir):
    users = wh.table(spark, sf_dir, "events").select(F.col("user_id").alias(SPEC.key))
    found = search.find_by_keys(_core_scored(spark, sf_dir), users)
    named = wh.with_identity(found, wh.identities(spark, sf_dir))
    return named.select(*SPEC.columns, AVERAGE, GRADE, STATUS)


@query
def search_regex(spark, sf_dir):
    return search.search(_scored(spark, sf_dir), SEARCH_PATTERN)


@query
def search_literal(spark, sf_dir):
    return search.search(_scored(spark, sf_dir), SEARCH_TEXT, literal=True)


@query
def find_by_id_sorted(spark, sf_dir):
    """From a table whose files are sorted by key; files without the key stay closed."""
    path = _ledger_of(wh.records(spark, sf_dir), "ledger")
    return scoring.score(ledger.read_range(spark, path, LOOKUP_KEY, LOOKUP_KEY))


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    path = _new_folder(spark, "trigrams")
    text_index.build(wh.records(spark, sf_dir), path)
    return path


@query
def search_regex_indexed(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return text_index.search_indexed(scored, _indexed(spark, sf_dir), SEARCH_PATTERN)


@query
def search_literal_indexed(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return text_index.search_indexed(scored, _indexed(spark, sf_dir), SEARCH_TEXT, literal=True)


@query
def low_attendance(spark, sf_dir):
    return lists.low_attendance(wh.records(spark, sf_dir))


@query
def by_study_hours(spark, sf_dir):
    return lists.by_study_hours(wh.records(spark, sf_dir))


@query
def at_risk(spark, sf_dir):
    return lists.at_risk(_scored(spark, sf_dir))


@query
def at_risk_reason(spark, sf_dir):
    return lists.at_risk_reasons(_scored(spark, sf_dir))


@query
def rel_attendance(spark, sf_dir):
    return lists.attendance_relation(_scored(spark, sf_dir))


@query
def rel_study_hours(spark, sf_dir):
    return lists.study_hours_relation(_scored(spark, sf_dir))


@query
def rel_attendance_grid(spark, sf_dir):
    return lists.relation_grid(_core_scored(spark, sf_dir), SPEC.attendance, 5.0)


@query
def rel_study_hours_grid(spark, sf_dir):
    return lists.relation_grid(_core_scored(spark, sf_dir), SPEC.hours, 1.0)


@query
def top_students(spark, sf_dir):
    best = lists.best_rows(_core_scored(spark, sf_dir))
    return lists.top_columns(wh.name_few(best, wh.identities(spark, sf_dir)))


@query
def top3_per_subject(spark, sf_dir):
    core = wh.core_records(spark, sf_dir).drop(SPEC.attendance, SPEC.hours)
    best = lists.best_rows_per_subject(core)
    named = wh.name_few(best, wh.identities(spark, sf_dir))
    return named.select("Subject", "Rank", SPEC.key, SPEC.name, "Mark")


# Statistics and distributions


@query
def class_statistics(spark, sf_dir):
    return stats.class_statistics(_core_scored(spark, sf_dir))


@query
def subject_averages(spark, sf_dir):
    return stats.subject_averages(wh.core_records(spark, sf_dir))


@query
def subject_averages_long(spark, sf_dir):
    return stats.subject_averages_long(wh.core_records(spark, sf_dir))


@query
def attendance_summary(spark, sf_dir):
    return stats.attendance_summary(wh.core_records(spark, sf_dir))


@query
def study_hours_summary(spark, sf_dir):
    return stats.study_hours_summary(wh.core_records(spark, sf_dir))


@query
def dashboard_kpis(spark, sf_dir):
    return stats.dashboard_kpis(_core_scored(spark, sf_dir))


@query
def dashboard_cards(spark, sf_dir):
    return stats.dashboard_cards(_core_scored(spark, sf_dir))


@query
def grade_distribution(spark, sf_dir):
    return dist.grade_distribution(_core_scored(spark, sf_dir))


@query
def status_distribution(spark, sf_dir):
    return dist.status_distribution(_core_scored(spark, sf_dir))


@query
def grade_distribution_dense(spark, sf_dir):
    return dist.grade_distribution_dense(_core_scored(spark, sf_dir))


@query
def status_distribution_dense(spark, sf_dir):
    return dist.status_distribution_dense(_core_scored(spark, sf_dir))


@query
def attendance_histogram(spark, sf_dir):
    return dist.attendance_histogram(wh.core_records(spark, sf_dir))


@query
def subject_box(spark, sf_dir):
    box = dist.subject_box(wh.core_records(spark, sf_dir))
    whole = ("Subject", "Marks", "Outliers")
    return box.select(*[c if c in whole else F.round(c, 4).alias(c) for c in box.columns])


@query
def subject_box_approx(spark, sf_dir):
    """Whether the quartiles of stored sketches, one per study time and subject, are
    within the bound on their rank."""
    core, path = wh.core_records(spark, sf_dir), _new_folder(spark, "sketches")
    sketches.mark_sketches(core, F.col(SPEC.hours)).write.parquet(path)
    box = sketches.box_of_sketches(spark.read.parquet(path))
    errors = sketches.rank_errors(core, box)
    within = [
        (F.col(f"{q}_Error") <= sketches.RANK_ERROR).alias(f"{q}_Within") for q, _ in sketches.QUARTILES
    ]
    return errors.select("Subject", "Marks", *within)


# Reports in SQL


@query
def sql_class_summary(spark, sf_dir):
    views.register_view(_core_scored(spark, sf_dir))
    return views.class_summary(spark)


@query
def sql_top_students(spark, sf_dir):
    views.register_view(_scored(spark, sf_dir))
    return views.top_students(spark)


@query
def sql_at_risk(spark, sf_dir):
    views.register_view(_scored(spark, sf_dir))
    return views.at_risk_students(spark)


# Support categories, model and evaluation


@query
def support_label(spark, sf_dir):
    return _core_labelled(spark, sf_dir)


@query
def support_distribution(spark, sf_dir):
    return dist.support_distribution(_core_labelled(spark, sf_dir))


@query
def split_sizes(spark, sf_dir):
    """Of the complete records, as they are split to train and evaluate a tree."""
    complete = _core_labelled(spark, sf_dir).filter(model.is_complete())
    return split.split_sizes(
        split.stratified_split(complete, SUPPORT, SPEC.key, LABELS), SUPPORT
    )


@query
def sample_counts(spark, sf_dir):
    return model.sample_counts(_core_labelled(spark, sf_dir))


@query
def suggestions(spark, sf_dir):
    return model.suggestion_rows(_core_labelled(spark, sf_dir))


@query
def explain_support(spark, sf_dir):
    core = wh.core_records(spark, sf_dir)
    return core.select(SPEC.key, explanation().alias("Explanation"))


def _trained(spark: SparkSession, sf_dir: str, **options) -> model.HoldOut:
    """The tree over a folder's records, loaded where it was trained on the same ones."""
    trees = f"{workspace(spark)}/trees"
    return model.train_and_hold_out(_core_labelled(spark, sf_dir), store=trees, **options)


@query
def class_weights(spark, sf_dir):
    weights = model.class_weights(_core_labelled(spark, sf_dir))
    return weights.withColumn(model.WEIGHT, F.round(model.WEIGHT, 6))


@query
def predict_support(spark, sf_dir):
    """Every record of the table, those with a missing feature without a category."""
    tree = _trained(spark, sf_dir).tree
    return model.with_advice(model.predict(tree, _core_labelled(spark, sf_dir)))


@query
def predict_hours_band(spark, sf_dir):
    """A tree that learns bands of whole study hours, which it can only learn exactly."""
    hours = F.col(SPEC.hours)
    high, moderate, on_track = LABELS
    band = F.when(hours <= 3, high).when(hours <= 5, moderate).otherwise(on_track)
    rows = wh.core_records(spark, sf_dir).drop(wh.CUSTOMER_KEY).withColumn(SUPPORT, band)
    predicted = model.with_advice(model.predict(model.train(rows), rows))
    return predicted.select(
        SPEC.key,
        F.col("Prediction.category").alias("Category"),
        F.col("Prediction.explanation").alias("Explanation"),
        F.array_join("Prediction.suggestions", " ").alias("Suggestions"),
    )


@query
def tree_evaluation(spark, sf_dir):
    return model.evaluation(_trained(spark, sf_dir))


@query
def tree_matrix(spark, sf_dir):
    return model.tree_report(_trained(spark, sf_dir)).matrix


@query
def tree_class_report(spark, sf_dir):
    return model.tree_report(_trained(spark, sf_dir)).report


@query
def tree_class_report_balanced(spark, sf_dir):
    """Of a tree that learned with class weights."""
    return model.tree_report(_trained(spark, sf_dir, balanced=True)).report


def _six_digits(df: DataFrame) -> DataFrame:
    """Measures as two engines print them alike."""
    return df.select(
        *[F.round(c, 6).alias(c) if c in evaluate.METRICS else c for c in df.columns]
    )


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The support rule as label and the plain risk flags as prediction."""
    scored = model.label_support(_core_scored(spark, sf_dir))
    return scored.withColumn(FLAG, scoring.risk_flag_category())


@query
def eval_metrics(spark, sf_dir):
    metrics = evaluate.evaluation_metrics(_flagged(spark, sf_dir), SUPPORT, FLAG, LABELS)
    return _six_digits(metrics)


@query
def eval_cards(spark, sf_dir):
    metrics = evaluate.evaluation_metrics(_flagged(spark, sf_dir), SUPPORT, FLAG, LABELS)
    return evaluate.metric_cards(metrics)


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_flagged(spark, sf_dir), SUPPORT, FLAG, LABELS)


@query
def confusion_matrix_wide(spark, sf_dir):
    return evaluate.confusion_matrix_wide(_flagged(spark, sf_dir), SUPPORT, FLAG, LABELS)


@query
def classification_report(spark, sf_dir):
    report = evaluate.classification_report(_flagged(spark, sf_dir), SUPPORT, FLAG, LABELS)
    return _six_digits(report)
