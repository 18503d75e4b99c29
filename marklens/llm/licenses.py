"""License scan by diagonal voting.

Every word pair of every text is joined by its hash to the places of the same
pair in short license texts. Matches that keep their distance to the template's
start lie on one diagonal; each diagonal is put together as a bit set of matched
places. Neighbouring diagonals of longer templates are merged, since an inserted
or missing word shifts the rest. A span is verified by how much of the template
its bits cover and how many words it takes.

Edge cases: a null text reads as empty; a text without a match has no labels and
score 0; rows with equal id and text have equal results; words are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marklens.llm.wordhash import PLAIN, buffers, chunks, grams, words

GRAM = 2

#: Fixed phrases and labels.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Further phrases and passages of this method, at most 60 words each.
MORE = (
    ("mit license", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("creative commons attribution", "cc-attribution"),
    ("public domain", "public-domain"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at",
        "apache-2.0",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        "gpl",
    ),
)


@dataclass(frozen=True)
class Voting:
    """band: diagonals this near are merged; cover: share of a template's pairs
    that a span must match; slack: words a span may take per template word.
    Templates of up to ``exact`` words must match whole, on one diagonal."""

    band: int = 3
    cover: float = 0.7
    slack: float = 1.5
    exact: int = 6


DEFAULT = Voting()



def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word count and hashes of all word pairs of each text."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for low, high in chunks(offsets):
            found = words(data, offsets[low : high + 1], PLAIN)
            counts = np.diff(found.first)
            pairs = np.maximum(counts - GRAM + 1, 0)
            every = grams(found.hashes, GRAM)
            # A pair that starts at a text's last word belongs to no text.
            inside = np.ones(len(every), bool)
            last = found.first[1:][counts > 0] - 1
            inside[last[last < len(every)]] = False
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(pairs)]), pa.int32()),
                pa.array(every[inside].view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    batch.column("key").slice(low, high - low),
                    pa.array(counts, pa.int64()),
                    lists,
                ],
                names=["doc_id", "key", "n_words", "grams"],
            )


def templates(spark: SparkSession, phrases=BASE + MORE) -> DataFrame:
    """A row per word pair of each template: gram, template, place, and its length."""
    rows = []
    for number, (text, label) in enumerate(phrases):
        raw = np.frombuffer(text.encode(), np.uint8)
        found = words(raw, np.array([0, len(raw)]), PLAIN)
        hashes = grams(found.hashes, GRAM).view(np.int64).tolist()
        if not 0 < len(hashes) < 64:
            raise ValueError("a template has 2 to 64 words")
        rows += [(h, number, place, len(hashes), label) for place, h in enumerate(hashes)]
    return spark.createDataFrame(
        rows, "gram long, template int, place int, pairs int, label string"
    )


def text_grams(docs: DataFrame) -> DataFrame:
    key = F.xxhash64(docs["doc_id"], docs["text"], docs["text"].isNull())
    rows = docs.select("doc_id", "text", key.alias("key"))
    return rows.mapInArrow(
        _text_grams, "doc_id long, key long, n_words long, grams array<long>"
    )


def diagonals(docs: DataFrame, phrases=BASE + MORE) -> DataFrame:
    """Matched places of each template, per text and diagonal, as a bit set.

    The templates are a short fixed list and broadcast; the texts' pairs are only
    streamed past them.
    """
    spark = docs.sparkSession
    places = text_grams(docs).select("key", F.posexplode("grams").alias("at", "gram"))
    hits = places.join(F.broadcast(templates(spark, phrases)), "gram")
    return (
        hits.groupBy("key", "template", "label", "pairs", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(
            F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"),
            F.min("at").alias("first"),
            F.max("at").alias("last"),
        )
    )


def verified(found: DataFrame, voting: Voting = DEFAULT) -> DataFrame:
    """Spans that cover their template: key, template, label, first, last, score."""
    short = F.col("pairs") < voting.exact
    whole = found.filter(short & (F.bit_count("bits") == F.col("pairs")))
    order = W.partitionBy("key", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    longer = found.filter(~short).withColumn(
        "opens", F.coalesce(gap > voting.band, F.lit(True)).cast("int")
    )
    merged = (
        longer.withColumn("group", F.sum("opens").over(order))
        .groupBy("key", "template", "label", "pairs", "group")
        .agg(
            F.bit_or("bits").alias("bits"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    cover = F.bit_count("bits") / F.col("pairs")
    takes = F.col("last") - F.col("first") + GRAM
    merged = merged.filter(
        (cover >= voting.cover) & (takes <= voting.slack * (F.col("pairs") + 1))
    )
    columns = ["key", "template", "label", "first", "last", cover.alias("score")]
    return whole.select(*columns).union(merged.select(*columns))


def report(docs: DataFrame, voting: Voting = DEFAULT) -> DataFrame:
    """One row per document: word count, base places, labels and best score."""
    spans = verified(diagonals(docs), voting)
    base = F.col("template") < len(BASE)
    start = F.when(base, F.col("first"))
    per_key = spans.groupBy("key").agg(
        F.count(start).alias("n_base"),
        F.min(start).cast("long").alias("first_word"),
        F.max(start).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias(
            "base_labels"
        ),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    rows = text_grams(docs).select("doc_id", "key", "n_words").join(per_key, "key", "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
