"""Quality by hierarchical empirical Bayes.

A classifier gives each document's evidence. Its site's quality is a prior: the
rate of good documents on a path is shrunk toward its host's, that toward the rate
of all. How strongly, is estimated from how much the rates differ (method of
moments), so sparse sites follow the group above them. Evidence and prior add up
as log odds.

Edge cases: a null text reads as empty; null hosts and paths are a site of their
own; repeated rows each count; without labelled rows of both classes there is no
evidence and the prior decides; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.llm.storage import keep
from marklens.llm.wordhash import SPACED, buffers, chunks, mix, words

#: The classifier is fitted on at most about so many labelled rows.
LABELLED = 20_000


@dataclass(frozen=True)
class Classifier:
    """Weights of standardised features; ``prior``: log odds among its rows."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


_CLASSES = 128 + 6


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of ASCII characters and of word-level traits, a row per text."""
    at = offsets - offsets[0]
    part = data[offsets[0] : offsets[-1]]
    rows, sizes = len(at) - 1, np.diff(at)
    out = np.zeros((rows, _CLASSES))
    of = np.repeat(np.arange(rows), sizes)
    ascii_ = part < 128
    counted = np.bincount(of[ascii_] * 128 + part[ascii_], minlength=rows * 128)
    size = np.maximum(sizes, 1)[:, None]
    out[:, :128] = counted.reshape(rows, 128) / size
    w = words(data, offsets, SPACED)
    n = np.diff(w.first)
    length = (w.ends - w.starts).astype(float)
    owner = w.rows
    last = part[w.ends - 1] if len(w.ends) else part[:0]
    initial = part[w.starts] if len(w.starts) else part[:0]
    per = np.maximum(n, 1)

    def share(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=rows) / per

    odd = ((last < 0x30) | ((last > 0x39) & (last < 0x41))) & (last != 0x2E) & (last != 0x2C)
    out[:, 128] = share(length) / 10
    out[:, 129] = share(((initial >= 0x41) & (initial <= 0x5A)).astype(float))
    out[:, 130] = share(odd.astype(float))
    out[:, 131] = share((length <= 1).astype(float))
    out[:, 132] = np.log1p(n) / 10
    _, different = np.unique(w.hashes ^ mix(owner.astype(np.uint64)), return_index=True)
    out[:, 133] = np.bincount(owner[different], minlength=rows) / per
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for low, high in chunks(offsets):
            values = _features(data, offsets[low : high + 1])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), _CLASSES)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label").slice(low, high - low),
                    lists.cast(pa.list_(pa.float64())),
                ],
                names=["label", "features"],
            )


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, steps: int = 25) -> Classifier:
    """Logistic regression on labelled rows, ``labels`` being (doc_id, label 0 or 1).

    At most about ``bound`` rows are used, chosen by a hash of their id; these ids
    are broadcast, and only their features reach the driver.
    """
    usable = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    total = usable.count()
    if total > bound:
        share = int(bound / total * 1_000_000)
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    rows = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
    rows = rows.select(F.col("label").cast("int").alias("label"), "text")
    found = rows.mapInArrow(_featured, "label int, features array<double>").toArrow()
    label = found.column("label").to_numpy().astype(float)
    values = found.column("features").combine_chunks().flatten().to_numpy()
    return _fitted(values.reshape(-1, _CLASSES), label, steps)


def _fitted(x: np.ndarray, label: np.ndarray, steps: int) -> Classifier:
    n = x.shape[1]
    good = label.sum()
    if not len(label) or good in (0, len(label)):
        return Classifier(np.zeros(n), np.ones(n), np.zeros(n + 1), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    # A trait that hardly varies must not dominate where it appears.
    scale = np.maximum(scale, 1e-3)
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    weights = np.zeros(n + 1)
    ridge = np.full(n + 1, 1.0)
    ridge[-1] = 1e-6
    for _ in range(steps):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (label - p) - ridge * weights
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, weights, float(np.log(good / (len(label) - good))))


def _scored(
    batches: Iterator[pa.RecordBatch], model: Classifier, keep_text: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        parts = [np.zeros(0)]
        for low, high in chunks(offsets):
            x = _features(data, offsets[low : high + 1])
            z = np.clip((x - model.mean) / model.scale, -8, 8)
            parts.append(z @ model.weights[:-1] + model.weights[-1] - model.prior)
        evidence = np.clip(np.concatenate(parts), -20, 20)
        names = ["row", "text"] if keep_text else ["row"]
        columns = [batch.column(name) for name in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(evidence)], names=[*names, "evidence"]
        )


def with_evidence(rows: DataFrame, model: Classifier, keep_text: bool = False) -> DataFrame:
    """(row, evidence) from (row, text): log odds of good without any prior.

    ``keep_text`` adds the text.
    """
    kind = rows.schema["row"].dataType.simpleString()
    text = "text string, " if keep_text else ""
    return rows.mapInArrow(
        partial(_scored, model=model, keep_text=keep_text), f"row {kind}, {text}evidence double"
    )


def _strength(mean: Column, spread: Column) -> Column:
    """Pseudo-counts of a Beta prior with this mean and variance between groups."""
    fitted = mean * (1 - mean) / F.greatest(spread, F.lit(1e-6)) - 1
    return F.least(F.greatest(fitted, F.lit(1.0)), F.lit(1000.0))


def site_rates(evidence: DataFrame, model: Classifier) -> DataFrame:
    """Shrunken rate of good documents of each (host, path).

    ``evidence`` has host, path and evidence of every document. All sums are
    grouped and combined before the shuffle, so a host with a third of all rows
    sends one row per task and path.
    """
    good = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(model.prior))))
    paths = evidence.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum(good).alias("good")
    )
    # Read several times below, and made by reading every text.
    paths = keep(paths, "site-counts")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    rate = F.col("host_good") / F.col("host_n")
    whole = hosts.agg(
        F.coalesce(F.sum("host_good") / F.sum("host_n"), F.lit(0.5)).alias("all_rate"),
        F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("spread"),
    ).select("all_rate", _strength(F.col("all_rate"), F.col("spread")).alias("all_strength"))
    # One row with the figures of all documents.
    all_rate, all_strength = whole.first()
    host_rate = (F.col("host_good") + all_rate * all_strength) / (F.col("host_n") + all_strength)
    hosts = hosts.select("host", host_rate.alias("host_rate"))
    joined = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    apart = F.col("good") / F.col("n") - F.col("host_rate")
    within = joined.agg(
        F.coalesce(F.avg("host_rate"), F.lit(0.5)).alias("mean"),
        F.coalesce(F.avg(apart * apart), F.lit(0.0)).alias("spread"),
    ).select(_strength(F.col("mean"), F.col("spread"))).first()[0]
    path_rate = (F.col("good") + F.col("host_rate") * within) / (F.col("n") + within)
    return joined.select("host", "path", "n", "host_rate", path_rate.alias("path_rate"))


def posterior(evidence: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds the probability that a document is good, from evidence and site.

    The join is left to Spark, which broadcasts the rates if they are small; else
    both sides come straight from a shuffle and a hot path is split.
    """
    same = evidence["host"].eqNullSafe(rates["host"]) & evidence["path"].eqNullSafe(rates["path"])
    joined = evidence.join(rates, same, "left").drop(rates["host"]).drop(rates["path"])
    p = F.least(F.greatest(F.coalesce("path_rate", F.lit(0.5)), F.lit(1e-4)), F.lit(1 - 1e-4))
    odds = F.col("evidence") + F.log(p / (1 - p))
    return joined.withColumn("probability", 1 / (1 + F.exp(-odds)))


def score(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    bound: int = LABELLED,
    keep_text: bool = False,
) -> DataFrame:
    """Every document as (row, host, path, evidence, host_rate, path_rate,
    probability), ``row`` holding its columns but for the text.

    The evidence is computed twice rather than stored with the texts. ``keep_text``
    adds the column ``text``.
    """
    model = fit(docs, labels, bound)
    site = [host.cast("string").alias("host"), path.cast("string").alias("path")]
    others = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("doc")
    sites = with_evidence(docs.select(F.struct(*site).alias("row"), "text"), model)
    rates = keep(site_rates(sites.select("row.*", "evidence"), model), "site-rates")
    rows = docs.select(F.struct(others, *site).alias("row"), "text")
    every = with_evidence(rows, model, keep_text).select(
        F.col("row.doc").alias("row"), "row.host", "row.path", "evidence", *["text"] * keep_text
    )
    return posterior(every, rates)


def good_documents(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, limit: float = 0.5
) -> DataFrame:
    """The documents whose probability reaches the limit, with all their columns."""
    scored = score(docs, labels, host, path, keep_text=True)
    stay = scored.filter(F.col("probability") >= limit)
    return stay.select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
