"""From raw documents to token ids, stage by stage.

Each stage takes the documents that the one before it kept and returns documents,
the last one token ids. Extra columns of the documents are carried along. A null
or empty text passes as such; equal rows without a doc_id all stay, those that share
one become one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marklens.llm import bpe, decontamination, neardup, quality, secrets
from marklens.llm.queries import vocabulary_path
from marklens.llm.storage import keep, table

#: No SQL expresses the trained classifier, the forest or the tokenizer.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the source is the host, the language
    the path."""
    labels = table(spark, sf_dir, "labels")
    known = labels.select("doc_id", labels["quality"].alias("label"))
    return quality.good_documents(docs, known, docs["source"], docs["lang"])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays. Unlike texts that share a
    doc_id all stay; equal rows become one."""
    gone = neardup.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    left = docs.filter("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti")
    place = F.row_number().over(W.partitionBy("doc_id", "text").orderBy(F.xxhash64("row")))
    rows = left.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    first = rows.withColumn("place", place).filter("place = 1").select("row.*")
    return first.unionByName(docs.filter("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that show a benchmark item go; those that mention one of one or two
    words stay."""
    items = table(spark, sf_dir, "benchmark")
    return decontamination.clean(docs, items, decontamination.PRODUCTION)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; every document stays."""
    return secrets.redact(docs, docs["doc_id"], docs["source"])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    encoded = bpe.encode(docs, bpe.load_spec(vocabulary_path()))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secrets", hide_secrets),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
