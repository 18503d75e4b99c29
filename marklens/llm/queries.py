"""The registered queries of the operators for training data."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marklens.llm import (
    bpe,
    clustering,
    decontamination,
    fingerprint,
    language,
    licenses,
    merkle,
    neardup,
    quality,
    secrets,
    sharding,
    substrings,
    wrappers,
)
from marklens.llm.storage import table, workspace

#: Name of the vocabulary file among those of the public tokenizers.
VOCABULARY = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_virtual_slots(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sharding.shard_by_bytes(docs, f"{workspace(spark)}/slot-map-{uuid.uuid4().hex}")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


@query
def op2_union_free_wrappers(spark, sf_dir):
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op3_template_windows(spark, sf_dir):
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.report(docs, benchmark, decontamination.PRODUCTION)


@query
def op4_site_bayes(spark, sf_dir):
    """The source is the host here, the language its path."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    known = labels.select("doc_id", labels["quality"].alias("label"))
    scored = quality.score(docs, known, docs["source"], docs["lang"])
    return scored.select(
        "row.doc_id",
        F.round("evidence", 6).alias("evidence"),
        F.round("host_rate", 6).alias("host_rate"),
        F.round("path_rate", 6).alias("path_rate"),
        F.round("probability", 6).alias("probability"),
        (F.col("probability") >= 0.5).alias("good"),
    )


@query
def op5_ownership_frequency(spark, sf_dir):
    """A document is a repository of its own here, its source the owner."""
    docs = table(spark, sf_dir, "documents")
    return secrets.report(docs, docs["doc_id"], docs["source"])


@query
def op6_improbable_features(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return fingerprint.edited_likeness(docs, fingerprint.rarity(docs))


@query
def op7_diagonal_voting(spark, sf_dir):
    return licenses.report(table(spark, sf_dir, "documents"))


@query
def op8_evidence_fusion(spark, sf_dir):
    pages, docs = (table(spark, sf_dir, t) for t in ("pages", "documents"))
    found = language.identify(pages, docs)
    return found.withColumn("probability", F.round("probability", 6))


@query
def op9_lsh_forest(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query
def op10_distinct_words(spark, sf_dir, vocabulary=None):
    spec = bpe.load_spec(vocabulary or vocabulary_path())
    encoded = bpe.encode(table(spark, sf_dir, "documents"), spec)
    return bpe.decode(encoded, spec, digests=True)


@query
def op11_super_k_mers(spark, sf_dir):
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_drift_tightening(spark, sf_dir):
    return clustering.report(table(spark, sf_dir, "embeddings"))


@query
def op13_pointer_jumping(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))
