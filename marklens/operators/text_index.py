"""Text search by an index of trigrams.

The index has a row per trigram and record: the trigrams of the name and of the
key's text in lower case, sorted by trigram, and a table with the number of records
per trigram. A search takes the rarest trigrams that every match must contain, reads
their postings alone, and lets the search itself confirm the records that have all.

A search without such a trigram (a short text, a choice of alternatives) reads all
records. Names with characters beyond ASCII are candidates of every search, since
letters of different length may be equal there when case is ignored.

At scale: a task sorts or groups about ``PER_TASK`` postings, so their number grows with
the table and a task's memory does not. The number is set, since postings shrink so much
when they are packed that partitions of equal bytes would hold many millions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marklens.operators.search import search
from marklens.spec import DEFAULT_SPEC, ScorecardSpec

#: Postings read for one search.
RAREST = 4
#: Postings that one task sorts or groups.
PER_TASK = 1_000_000
_BEYOND = ""  # the entry of names that are always candidates
_POSTINGS, _COUNTS = "postings", "counts"


def _trigrams(text: str) -> str:
    """SQL for the distinct trigrams of a lower-case text."""
    places = f"sequence(1, greatest(length({text}) - 2, 0))"
    cut = f"transform({places}, i -> substr({text}, i, 3))"
    return f"if(length({text}) < 3, array(), {cut})"


def postings(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """Trigram and key, each pair once."""
    name, key = f"lower(coalesce(`{spec.name}`, ''))", f"cast(`{spec.key}` AS string)"
    beyond = f"if(`{spec.name}` rlike '[^\\\\x00-\\\\x7F]', array('{_BEYOND}'), array())"
    grams = f"array_distinct(concat({_trigrams(name)}, {_trigrams(f'coalesce({key}, "")')}, {beyond}))"
    return df.select(spec.key, F.explode(F.expr(grams)).alias("gram"))


def _tasks(postings: int | None) -> int:
    return max(1, -(-(postings or 0) // PER_TASK))


def most_postings(df: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC) -> int:
    """A bound on the table's postings, from the lengths of names and keys alone."""
    lengths = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in (spec.name, spec.key)]
    per_record = lengths[0] + lengths[1] + F.lit(1)
    return df.agg(F.sum(per_record)).first()[0] or 0


def build(df: DataFrame, path: str, spec: ScorecardSpec = DEFAULT_SPEC) -> None:
    """Write the index of a record table. Keys join the sort, so that a trigram that
    most names have is spread over files. Records are dealt to as many tasks first: a
    shuffle to many tasks holds what a task sends, which a scan has too much of."""
    tasks = _tasks(most_postings(df, spec))
    dealt = df.select(spec.key, spec.name).repartition(tasks, spec.key, spec.name)
    rows = postings(dealt, spec).repartitionByRange(tasks, "gram", spec.key)
    rows.sortWithinPartitions("gram", spec.key).write.parquet(f"{path}/{_POSTINGS}")
    written = df.sparkSession.read.parquet(f"{path}/{_POSTINGS}")
    counts = written.groupBy("gram").agg(F.count("*").alias("records"))
    counts.sort("gram").write.parquet(f"{path}/{_COUNTS}")


# Escapes that stand for one position or for one character of a class.
_CLASSES = set("dDwWsSbBAzZhHvVRtnrf")


def required_runs(pattern: str) -> list[str]:
    """Plain ASCII texts, in lower case, that every match of a pattern contains.

    Only what is certain is taken; with an alternative, an inline flag or a quoted
    part nothing is.
    """
    runs, run, i, n = [], "", 0, len(pattern)
    if "|" in pattern or "(?" in pattern or "&&" in pattern:
        return []
    while i < n:
        c, i = pattern[i], i + 1
        if c == "\\":
            if i >= n or (pattern[i].isalnum() and pattern[i] not in _CLASSES):
                return []
            literal = "" if pattern[i].isalnum() else pattern[i]
            i += 1
        elif c in "([":
            i = _closing(pattern, i, c)
            if i < 0:
                return []
            literal = ""
        elif c in "*?{":
            # The character before may be missing.
            run, literal = run[:-1], ""
            i = pattern.find("}", i) + 1 if c == "{" else i
            if not i:
                return []
        elif c in ".^$+)]}":
            literal = ""
        else:
            literal = c
        if literal and literal.isascii():
            run += literal.lower()
        else:
            runs, run = [*runs, run], ""
    return [r for r in [*runs, run] if r]


def _closing(pattern: str, i: int, opened: str) -> int:
    """Behind the end of a group or class, or -1 where that is not plain to see."""
    closes = {"(": ")", "[": "]"}[opened]
    while i < len(pattern):
        c = pattern[i]
        if c == closes:
            return i + 1
        if c == "\\":
            i += 1
        elif c in "([":
            return -1
        i += 1
    return -1


def _needed(query: str, literal: bool) -> set[str]:
    if not literal:
        runs = required_runs(query)
    else:
        runs = "".join(c if c.isascii() else "\0" for c in query.lower()).split("\0")
    return {run[i : i + 3] for run in runs for i in range(len(run) - 2)}


def search_indexed(
    df: DataFrame, path: str, query: str, literal: bool = False, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """What ``search`` finds in the records that the index in ``path`` was built of.

    The driver gets the number of records of the query's own trigrams.
    """
    grams = _needed(query, literal) if query.strip() else set()
    if not grams:
        return search(df, query, literal, spec)
    candidates = candidate_keys(df.sparkSession, path, grams, spec)
    return search(df.join(candidates, spec.key, "left_semi"), query, literal, spec)


def candidate_keys(
    spark: SparkSession, path: str, grams: set[str], spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Keys of the records that have all of the rarest trigrams, and those that are
    always candidates.

    A key's few postings meet unreduced: a frequent trigram's file is small but names
    so many keys that a scan task could not group them. The last shuffle sends the
    candidates alone, so that few of them can be broadcast.
    """
    counts = spark.read.parquet(f"{path}/{_COUNTS}")
    asked = F.col("gram").isin(*sorted(grams), _BEYOND)
    known = {r["gram"]: r["records"] for r in counts.filter(asked).collect()}
    rarest = sorted(grams, key=lambda g: (known.get(g, 0), g))[:RAREST]
    found = spark.read.parquet(f"{path}/{_POSTINGS}").filter(F.col("gram").isin(*rarest, _BEYOND))
    tasks = _tasks(sum(known.get(g, 0) for g in (*rarest, _BEYOND)))
    met = found.select(spec.key, (F.col("gram") == _BEYOND).alias("beyond")).repartition(tasks, spec.key)
    per_key = met.groupBy(spec.key).agg(
        F.count_if(~F.col("beyond")).alias("n"), F.max("beyond").alias("always")
    )
    candidates = per_key.filter((F.col("n") == len(rarest)) | F.col("always"))
    return candidates.select(spec.key).repartition(spec.key)
