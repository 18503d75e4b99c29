"""Exact stratified hold-out split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IS_TEST = "Is_Test"
BUCKET_BITS = 16


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    labels: Sequence[str],
    share: float = 0.2,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add ``Is_Test`` for the share of all rows, rounded up, in the labels' proportions.

    Each label gives its part of the total rounded down; the rows that are then
    missing go to the labels with the largest remainders, the first of equal ones.

    Rows are ordered by a hash of the unique key and the first ones are the test
    rows. Ranking a label in one window would sort a third of the table in one
    task. Instead, counts per slot (a label's hash bucket) show in which slot the
    cut falls, only that slot is ranked, and every row then compares its own hash
    with the cut. The broadcasts have one row per label. Rows with a label not
    in ``labels`` are training rows.
    """
    buckets = 1 << bucket_bits
    number = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)) - 1
    bucket = F.shiftrightunsigned("split_hash", 64 - bucket_bits)
    hashed = df.withColumns(
        {"split_label": number, "split_hash": F.xxhash64(key)}
    ).withColumn("split_slot", F.col("split_label") * F.lit(buckets) + bucket)
    known = hashed.filter(F.col("split_label") >= 0).select("split_slot", "split_hash", key)
    label_of_slot = F.floor(F.col("split_slot") / buckets)

    slots = (
        known.groupBy("split_slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("split_label", label_of_slot)
    )
    running = Window.partitionBy("split_label").orderBy("split_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto, wanted, n = F.col("upto"), F.col("wanted"), F.col("n")
    cut_slots = (
        slots.withColumn("upto", F.sum("n").over(running))
        .join(F.broadcast(_test_sizes(slots, share)), "split_label")
        .filter((upto >= wanted) & (upto - n < wanted))
        .select("split_slot", (wanted - upto + n).alias("rank_in_slot"))
    )

    by_hash = Window.partitionBy("split_slot").orderBy("split_hash", key)
    cuts = (
        known.join(F.broadcast(cut_slots), "split_slot")
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") == F.col("rank_in_slot"))
        .select(
            label_of_slot.alias("cut_label"),
            F.col("split_slot").alias("cut_slot"),
            F.col("split_hash").alias("cut_hash"),
            F.col(key).alias("cut_key"),
        )
    )

    # Hashes of one bucket share their top bits, so signed comparison is in order there.
    slot, hash_ = F.col("split_slot"), F.col("split_hash")
    cut_slot, cut_hash = F.col("cut_slot"), F.col("cut_hash")
    earlier_key = (hash_ == cut_hash) & (F.col(key) <= F.col("cut_key"))
    is_test = (slot < cut_slot) | ((slot == cut_slot) & ((hash_ < cut_hash) | earlier_key))
    return (
        hashed.join(F.broadcast(cuts), F.col("split_label") == F.col("cut_label"), "left")
        .withColumn(IS_TEST, F.coalesce(is_test, F.lit(False)))
        .select(*df.columns, IS_TEST)
    )


def _test_sizes(slots: DataFrame, share: float) -> DataFrame:
    """Wanted test rows per label, by largest remainder; one row per label."""
    every = Window.partitionBy(F.lit(0))
    exact = "decimal(38, 0)"
    per_label = slots.groupBy("split_label").agg(F.sum("n").cast(exact).alias("n"))
    total = F.sum("n").over(every).cast(exact)
    # The share of a whole number is rounded up unless it is whole but for the last bits.
    test = F.ceil(F.round(F.sum("n").over(every).cast("double") * share, 6)).cast(exact)
    quota = per_label.select("split_label", "n", total.alias("total"), test.alias("test"))
    quota = quota.select(
        "split_label",
        "test",
        F.expr("cast(n * test div total AS bigint)").alias("part"),
        F.expr("cast(n * test % total AS double) / cast(total AS double)").alias("rest"),
    )
    largest = Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), "split_label")
    missing = F.col("test").cast("bigint") - F.sum("part").over(every)
    more = F.when(F.row_number().over(largest) <= missing, 1).otherwise(0)
    return quota.select("split_label", (F.col("part") + more).alias("wanted"))


def split_sizes(split: DataFrame, label: str) -> DataFrame:
    """Training and test rows per label."""
    return split.groupBy(label).agg(
        F.count_if(~F.col(IS_TEST)).alias("Training_Samples"),
        F.count_if(F.col(IS_TEST)).alias("Test_Samples"),
    )
