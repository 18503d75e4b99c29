"""Validation of incoming records and their addition to the stored table.

Submissions are text columns plus a unique ``Ingest_Order``. Adding a batch is
the same as adding its rows one at a time in that order: a row is refused when
its key is stored already or when an earlier row with that key was accepted.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.functions.text import strip, to_double, to_long
from marklens.sources import ledger
from marklens.sources import records as store
from marklens.spec import DEFAULT_SPEC, INGEST_ORDER, REJECT_REASON, ScorecardSpec

# The messages of the entry form.
NOT_A_NUMBER = "Please enter valid numeric values."
DUPLICATE_KEY = "Student ID already exists!"
BLANK_NAME = "Name cannot be empty."
ATTENDANCE_RANGE = "Attendance must be between 0 and 100."
NEGATIVE_HOURS = "Study hours cannot be negative."
MARK_RANGE = "Marks must be between {low:g} and {high:g}."
# Messages for limits that the form's input fields impose.
KEY_RANGE = "Student ID must be at least {low}."
UNKNOWN_GROUP = "{group} must be one of {choices}."
TOO_MANY_HOURS = "Study hours must not exceed {limit:g}."



def parse(submissions: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Typed columns; text that is no number becomes null, a missing column is blank."""

    def text(column: str) -> Column:
        return F.col(column) if column in submissions.columns else F.lit("")

    return submissions.select(
        to_long(text(spec.key)).alias(spec.key),
        strip(text(spec.name)).alias(spec.name),
        strip(text(spec.group)).alias(spec.group),
        *[to_double(text(c)).alias(c) for c in spec.numeric],
        INGEST_ORDER,
    )


def own_fault(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """First rule a parsed row breaks by itself, duplicates aside; null if none."""
    attendance, hours = F.col(spec.attendance), F.col(spec.hours)
    marks = [F.col(s) for s in spec.subjects]
    missing = reduce(or_, [F.col(c).isNull() for c in spec.numeric])
    bad_mark = reduce(or_, [~m.between(spec.mark_min, spec.mark_max) for m in marks])
    fault = (
        F.when(missing, NOT_A_NUMBER)
        .when(F.coalesce(F.col(spec.name), F.lit("")) == "", BLANK_NAME)
    )
    if spec.groups is not None:
        known = F.coalesce(F.col(spec.group).isin(*spec.groups), F.lit(False))
        choices = ", ".join(spec.groups)
        fault = fault.when(~known, UNKNOWN_GROUP.format(group=spec.group, choices=choices))
    fault = (
        fault.when(~attendance.between(0, 100), ATTENDANCE_RANGE)
        .when(hours < 0, NEGATIVE_HOURS)
    )
    if spec.hours_max is not None:
        fault = fault.when(
            hours > spec.hours_max, TOO_MANY_HOURS.format(limit=spec.hours_max)
        )
    return fault.when(bad_mark, MARK_RANGE.format(low=spec.mark_min, high=spec.mark_max))


def key_fault(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    key = F.col(spec.key)
    fault = F.when(key.isNull(), NOT_A_NUMBER)
    if spec.key_min is None:
        return fault
    return fault.when(key < spec.key_min, KEY_RANGE.format(low=spec.key_min))


def existing_keys(
    incoming: DataFrame, stored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Distinct incoming keys that are stored.

    The batch's distinct keys are the small side. Stored keys stream past them:
    Spark broadcasts the batch when it is small enough and shuffles otherwise,
    and a key that fills much of the batch collapses before either.
    """
    keys = incoming.select(spec.key).filter(F.col(spec.key).isNotNull()).distinct()
    return stored.select(spec.key).join(keys, spec.key, "left_semi").distinct()


def new_keys(
    incoming: DataFrame, stored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Distinct incoming keys that are not stored."""
    keys = incoming.select(spec.key).filter(F.col(spec.key).isNotNull()).distinct()
    return keys.join(existing_keys(keys, stored, spec), spec.key, "left_anti")


def validate(
    submissions: DataFrame, stored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Parsed rows with ``Reject_Reason``, null where the row is accepted.

    Rules in order, first failure wins: key is a number, key is positive, key is
    new, other fields are numbers, name, attendance, hours, marks.

    What the rules need to know about a key is gathered once per key, so a key
    with many rows is combined map-side, and then joined back to the rows. Both
    sides of that join come straight from a shuffle, so adaptive execution splits
    the rows of a frequent key, however many there are. Rows that need nothing
    from the join bear a value no key has, which spreads them over the partitions
    instead of sending them all to one.
    """
    rows = parse(submissions, spec).withColumns(
        {"key_fault": key_fault(spec), "own_fault": own_fault(spec)}
    )
    # As a decimal the key is not what the facts are partitioned by already, hence the
    # shuffle of their own; and there are values that no key has.
    wide = "decimal(21, 0)"
    facts = _key_facts(rows, stored, spec).select(
        F.col(spec.key).cast(wide).alias("fact_key"), "first_good", "is_stored"
    )
    beyond = F.xxhash64(INGEST_ORDER).cast(wide) + F.lit("1" + "0" * 20).cast(wide)
    keyed = F.col("key_fault").isNull()
    join_key = F.when(keyed, F.col(spec.key).cast(wide)).otherwise(beyond.cast(wide))
    duplicate = F.col("is_stored") | (F.col(INGEST_ORDER) > F.col("first_good"))
    return (
        rows.withColumn("join_key", join_key)
        .join(facts, F.col("join_key") == F.col("fact_key"), "left")
        .withColumn(
            REJECT_REASON,
            F.coalesce("key_fault", F.when(duplicate, DUPLICATE_KEY), "own_fault"),
        )
        .select(*spec.columns, INGEST_ORDER, REJECT_REASON)
    )


def _key_facts(rows: DataFrame, stored: DataFrame, spec: ScorecardSpec) -> DataFrame:
    """Per key: the first row fit to be stored, and whether the key is stored."""
    fit = F.col("own_fault").isNull()
    per_key = (
        rows.filter(F.col("key_fault").isNull() & F.col(spec.key).isNotNull())
        .groupBy(spec.key)
        .agg(F.min(F.when(fit, F.col(INGEST_ORDER))).alias("first_good"))
    )
    present = existing_keys(per_key, stored, spec).withColumn("is_stored", F.lit(True))
    return per_key.join(present, spec.key, "left")


def accepted(validated: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return validated.filter(F.col(REJECT_REASON).isNull()).select(*spec.columns)


def rejected(validated: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    return validated.filter(F.col(REJECT_REASON).isNotNull())


def append_new(
    submissions: DataFrame, stored: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """The stored table as it is after the batch."""
    fresh = accepted(validate(submissions, stored, spec), spec)
    return stored.select(*spec.columns).unionByName(fresh)


def append_to(
    submissions: DataFrame,
    path: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
    storage: str = "csv",
) -> None:
    """Add a batch to the table at ``path``; only new files are written.

    Running it again adds nothing, since the keys are stored by then.
    """
    spark = submissions.sparkSession
    store.create_empty(spark, path, spec, storage)
    stored = store.read_records(spark, path, spec, storage=storage)
    store.append(accepted(validate(submissions, stored, spec), spec), path, spec, storage)


def append_committed(
    submissions: DataFrame,
    path: str,
    spec: ScorecardSpec = DEFAULT_SPEC,
    stream: str | None = None,
    batch: int | None = None,
) -> int:
    """Add a batch to a table in versions; returns the version that has it.

    Any number of writers may add at the same time. A batch is judged by the version
    it starts from. When another writer commits first, only the keys added since are
    looked at: a row accepted before is still the first good one of its key, and has
    to go only if its key is stored by now. A ``batch`` of a ``stream`` that a version
    has already, or a later one of that stream, is not added again.
    """
    spark = submissions.sparkSession
    base = ledger.latest(spark, path)
    if base.has(stream, batch):
        return base.number
    stored = ledger.read_folders(spark, path, base.folders, spec)
    fresh = accepted(validate(submissions, stored, spec), spec)
    folder = ledger.write_folder(fresh, path, spec)
    while not ledger.commit(spark, path, base.after(folder, stream, batch)):
        newer = ledger.latest(spark, path)
        if newer.has(stream, batch):
            ledger.drop_folder(spark, path, folder)
            return newer.number
        since = tuple(name for name in newer.folders if name not in base.folders)
        taken = ledger.read_folders(spark, path, since, spec).select(spec.key)
        own = ledger.read_folders(spark, path, (folder,), spec)
        left = ledger.write_folder(own.join(taken, spec.key, "left_anti"), path, spec)
        ledger.drop_folder(spark, path, folder)
        base, folder = newer, left
    return base.number + 1


def existing_in_ranges(
    incoming: DataFrame, path: str, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Distinct incoming keys that a table in versions holds; only files whose key
    range meets that of the batch are opened."""
    spark = incoming.sparkSession
    low, high = incoming.agg(F.min(spec.key), F.max(spec.key)).first()
    if low is None:
        return incoming.select(spec.key).filter("false")
    return existing_keys(incoming, ledger.read_range(spark, path, low, high, spec), spec)
