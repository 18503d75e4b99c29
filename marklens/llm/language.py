"""Language of web pages by Bayesian evidence fusion.

A page's text has a likelihood under each language's model of byte trigrams. The
language its markup declares, the address suffix and the host are further
evidence. How far each of these can be trusted is learnt from the pages: counts of
what the text says, grouped by declaration, by suffix and by host. A host's
distribution is shrunk toward its suffix's and that toward that of all pages, so
a sparse host follows the group above it. Logarithms add up.

Edge cases: a null text or page reads as empty and gives no text evidence; a page
without declaration, suffix or host uses the group of those without; languages
that no labelled document has can't be found; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.llm.storage import keep
from marklens.llm.wordhash import buffers, chunks
from marklens.llm.wrappers import host_of

#: The text models are fitted on at most about so many labelled documents.
LABELLED = 20_000
#: Buckets of trigrams.
BUCKETS = 1 << 15
#: Text evidence per trigram is weakened, since neighbours are not independent, and
#: bounded.
TEMPER, MOST = 0.25, 60.0
#: Pseudo-counts by which a group is shrunk toward the one above it.
STRENGTH = 5.0

_UNSEEN = re.compile(rb"<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)


def _trigrams(part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of letter trigrams and the row of each; at: row offsets."""
    n = len(part) - 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = part.astype(np.uint32)
    upper = (low >= 0x41) & (low <= 0x5A)
    low[upper] += 32
    letter = (part >= 0x80) | ((low >= 0x61) & (low <= 0x7A))
    low[~letter] = 0x20
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 15)
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = (rows[:-2] == rows[2:]) & letter[1:-1]
    return bucket[inside].astype(np.int64), rows[:-2][inside]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        names = np.array(batch.column("lang").to_pylist(), dtype=object)
        for low, high in chunks(offsets):
            at = offsets[low : high + 1]
            found, rows = _trigrams(data[at[0] : at[-1]], at - at[0])
            langs = names[low:high]
            for lang in set(langs):
                mine = np.isin(rows, np.flatnonzero(langs == lang))
                counts = np.bincount(found[mine], minlength=BUCKETS)
                totals[lang] = totals.get(lang, 0) + counts
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])],
            names=["lang", "bucket", "n"],
        )


def fit(labelled: DataFrame, bound: int = LABELLED) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities of trigram buckets, from (text, lang).

    At most about ``bound`` rows are used, chosen by a hash of the text. Counts are
    grouped in Spark; the driver gets one number per language and bucket.
    """
    usable = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    total = usable.count()
    if total > bound:
        share = int(bound / total * 1_000_000)
        usable = usable.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share)
    counted = usable.mapInArrow(_counted, "lang string, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    table = np.full((len(languages), BUCKETS), 0.5)
    for number, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        table[number, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def _scored(
    batches: Iterator[pa.RecordBatch], model: np.ndarray, markup: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        if markup:
            seen = [
                _UNSEEN.sub(b" ", (x.as_py() or "").encode()).decode("utf-8", "replace")
                for x in texts
            ]
            texts = pa.array(seen, pa.large_string())
        data, offsets = buffers(texts)
        rows = []
        for low, high in chunks(offsets):
            at = offsets[low : high + 1]
            found, of = _trigrams(data[at[0] : at[-1]], at - at[0])
            scores = np.stack(
                [np.bincount(of, weights=m[found], minlength=high - low) for m in model], axis=1
            )
            scores = TEMPER * (scores - scores.max(axis=1, keepdims=True))
            rows.append(np.maximum(scores, -MOST))
        values = np.concatenate(rows) if rows else np.zeros((0, len(model)))
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(values) + 1) * len(model), pa.int32()), pa.array(values.ravel())
        )
        yield pa.RecordBatch.from_arrays([batch.column("row"), lists], names=["row", "likelihood"])


def with_likelihood(rows: DataFrame, model: np.ndarray, markup: bool = False) -> DataFrame:
    """(row, likelihood) from (row, text): log likelihoods, the greatest being 0."""
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_scored, model=model, markup=markup), f"row {kind}, likelihood array<double>"
    )


def declared(html: Column) -> Column:
    """Main part of the language that the html element declares; null without one."""
    found = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1)
    return F.lower(F.nullif(found, F.lit("")))


def suffix(host: Column) -> Column:
    found = F.regexp_extract(host, r"\.([a-z]{2,})$", 1)
    return F.nullif(found, F.lit(""))


def _smoothed(above: Column) -> Column:
    """Shares per language of a group's soft counts, shrunk toward ``above``."""
    total = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    return F.transform(
        "counts",
        lambda x, i: (x + F.lit(STRENGTH) * F.get(above, i)) / (total + F.lit(STRENGTH)),
    )


def _soft_counts(pages: DataFrame, n: int, *keys: str) -> DataFrame:
    """Sums of the text's language shares per group; combined before the shuffle."""
    sums = [F.sum(F.get("shares", F.lit(i))) for i in range(n)]
    return pages.groupBy(*keys).agg(F.array(*sums).alias("counts"))


def identify(
    pages: DataFrame, labelled: DataFrame, bound: int = LABELLED
) -> DataFrame:
    """Language of every page of (page_id, url, html), as (page_id, url, language,
    probability, text_language, declared, suffix).

    Text scores are stored once; groups are aggregates of them. Tables of groups
    are joined by Spark's choice: broadcast if small, else both sides are shuffled
    and a hot host is split.
    """
    languages, model = fit(labelled, bound)
    n = len(languages)
    host = host_of(pages["url"])
    columns = pages.select(
        F.struct(
            "page_id", "url", host.alias("host"), suffix(host).alias("suffix"),
            declared(pages["html"]).alias("declared"),
        ).alias("row"),
        F.col("html").alias("text"),
    )
    if not n:
        nothing = F.lit(None).cast("string")
        return columns.select(
            "row.page_id", "row.url", nothing.alias("language"),
            F.lit(None).cast("double").alias("probability"), nothing.alias("text_language"),
            "row.declared", "row.suffix",
        )
    scored = with_likelihood(columns, model, markup=True)
    raised = F.transform("likelihood", F.exp)
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    shares = F.transform(raised, lambda x: x / total)
    scored = keep(scored.select("row.*", "likelihood", shares.alias("shares")), "page-scores")

    sums = [F.sum(F.get("shares", F.lit(i))) for i in range(n)]
    first = scored.agg(*sums).first()  # one row for all pages
    counts = np.array([x or 0.0 for x in first]) + 1.0
    everywhere = F.array(*[F.lit(float(x)) for x in counts / counts.sum()])

    suffixes = keep(
        _soft_counts(scored, n, "suffix").select(
            F.col("suffix").alias("s"), _smoothed(everywhere).alias("suffix_shares")
        ),
        "suffixes",
    )
    hosts = _soft_counts(scored, n, "host", "suffix").join(
        suffixes, F.col("suffix").eqNullSafe(F.col("s")), "left"
    )
    hosts = keep(
        hosts.select(
            F.col("host").alias("h"), _smoothed(F.col("suffix_shares")).alias("prior")
        ),
        "hosts",
    )
    # P(declared | language): counts of a declaration over those of all, smoothed.
    kinds = _soft_counts(scored, n, "declared")
    said = keep(
        kinds.select(
            F.col("declared").alias("d"),
            F.transform(
                "counts",
                lambda x, i: F.log(
                    (x + F.lit(0.5)) / (F.get(F.array(*[F.lit(float(c)) for c in counts]), i) + 1.0)
                ),
            ).alias("declaration"),
        ),
        "declarations",
    )
    joined = scored.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left").join(
        said, F.col("declared").eqNullSafe(F.col("d")), "left"
    )
    evidence = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.get("likelihood", i) + F.get("declaration", i) + F.log(F.get("prior", i)),
    )
    fused = joined.withColumn("evidence", evidence)
    weight = F.aggregate(
        "evidence", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("evidence"))
    )
    names = F.array(*[F.lit(x) for x in languages])

    def best(values: str) -> Column:
        return F.get(names, F.array_position(values, F.array_max(values)).cast("int") - 1)

    return fused.select(
        "page_id",
        "url",
        best("evidence").alias("language"),
        (F.lit(1.0) / weight).alias("probability"),
        F.when(F.array_min("likelihood") < 0, best("likelihood")).alias("text_language"),
        "declared",
        "suffix",
    )
