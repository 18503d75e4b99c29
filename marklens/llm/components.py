"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.llm.storage import keep


def _total(labels: DataFrame):
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]


def _lowered(links: DataFrame, labels: DataFrame) -> DataFrame:
    """One round: every label gives way to its own label, and the greater of the two
    labels of a link, with the id that bears it, to the smaller one."""
    left, right = labels.alias("left"), labels.alias("right")
    jumped = left.join(right, F.col("left.label") == F.col("right.id")).select(
        F.col("left.id").alias("id"), F.col("right.label").alias("label")
    )
    met = links.join(jumped.toDF("a", "label_a"), "a").join(jumped.toDF("b", "label_b"), "b")
    # Of a link within a component nothing is left.
    apart = met.filter("label_a <> label_b").selectExpr(
        "if(label_a < label_b, b, a) AS id",
        "greatest(label_a, label_b) AS high",
        "least(label_a, label_b) AS label",
    )
    offers = apart.select(F.explode(F.array("id", "high")).alias("id"), "label")
    return jumped.union(offers).groupBy("id").agg(F.min("label").alias("label"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Smallest reachable id of every linked id, as (id, label).

    ``links`` has the long columns a and b, in any direction and repetition.
    ``known`` holds labels of an earlier call, to go on from there: the links are
    then taken between the known components, and only those that they join take part.

    Rounds end when the sum of the labels, which can only fall, stays; their number
    grows with the logarithm of the longest chain. Labels are written each round, so
    a lost executor costs one round, and joins take stored tables, so adaptive
    execution can split an id with very many links. Minima are combined before the
    shuffle, one a round.
    """
    if known is not None:
        names = known.select("id", "label")
        met = links.select("a", "b").join(names.toDF("a", "label_a"), "a", "left")
        met = met.join(names.toDF("b", "label_b"), "b", "left")
        joined = components(met.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")))
        # Each known component has a row of its own label, so that row tells the new one.
        moved = names.join(joined.toDF("label", "to"), "label", "left")
        moved = moved.select("id", F.coalesce("to", "label").alias("label"))
        return keep(moved.union(joined).distinct(), "labels")
    once = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    once = keep(once.distinct(), "links")
    ends = once.select(F.explode(F.array("a", "b")).alias("id"), F.col("a").alias("label"))
    labels = keep(ends.groupBy("id").agg(F.min("label").alias("label")), "labels")
    before = _total(labels)
    while before is not None:
        labels = keep(_lowered(once, labels), "labels")
        after = _total(labels)
        if after == before:
            break
        before = after
    return labels
