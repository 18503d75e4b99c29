"""Secret scan by corpus-wide ownership frequency; DataFrame functions only.

Patterns give candidate spans. A candidate's value is then counted over the whole
corpus: in how many repositories and among how many owners it occurs. A value that
many owners share is an example someone copied; one that stays with an owner and
looks random is taken for live.

Edge cases: a null text reads as empty; an empty text has no spans; a null owner
or repository counts as one of its own; rows with equal key and text have equal
spans; a table without candidates gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marklens.llm.storage import keep


@dataclass(frozen=True)
class Kind:
    """name; pattern; group: holds the value; least: its characters; hint: plain
    text that every match has, looked for first; base: one of the fixed kinds."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str | None = None
    base: bool = False


#: Fixed kinds, in the order in which they are listed at equal starts.
BASE = (
    Kind(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", least=20, hint="AKIA", base=True),
    # Runs are maximal, so a lower limit in the pattern drops the short ones.
    Kind("hex", r"[0-9a-f]{24,}", least=24, base=True),
)

#: Further kinds of this method.
MORE = (
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{6,}", least=24, hint="eyJ"),
    Kind("forge", r"gh[oprsu]_[A-Za-z0-9]{30,}", least=34, hint="gh"),
    # The whole key, to the end of the text if it is cut off; its body is the value.
    Kind(
        "pem",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----((?s:.*?))(?:-----END [A-Z ]*PRIVATE KEY-----|\z)",
        group=1,
        hint="PRIVATE KEY-----",
    ),
    Kind("login", r"[a-z]{1,20}://[^\s/:@]+:([^\s/:@]+)@", group=1, least=6, hint="://"),
)

KINDS = BASE + MORE

#: Owners from which on a value counts as widely copied.
SHARED_OWNERS = 3
#: Length and different characters from which on a value looks random.
LIVE_LENGTH, LIVE_CHARACTERS = 16, 8


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (piece before the match, match, value); null without a match."""
    pattern = F.lit(kind.pattern)
    found = text.rlike(kind.pattern)
    if kind.hint:
        found = F.contains(text, F.lit(kind.hint)) & found
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(kind.group))
    zipped = F.arrays_zip(
        F.split(text, kind.pattern).alias("piece"), whole.alias("match"), value.alias("value")
    )
    # Only lengths of the text around go on.
    slim = F.transform(
        zipped,
        lambda x: F.struct(
            F.length(x["piece"]).alias("gap"),
            F.length(x["match"]).alias("length"),
            x["value"].alias("value"),
        ),
    )
    return F.when(found, slim)


def row_key(docs: DataFrame) -> Column:
    """Equal for rows of equal id and text, null or not."""
    return F.xxhash64(docs["doc_id"], docs["text"], docs["text"].isNull())


def spans(
    docs: DataFrame, repository: Column, owner: Column, kinds: tuple[Kind, ...] = KINDS
) -> DataFrame:
    """A row per candidate: key, repository, owner, kind, rank, start, end, value.

    Positions count code points from 0, the end excluded. The pieces between the
    matches are summed up within a text, so each text is searched only a fixed
    number of times, and no text is shuffled.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    found = F.array(
        *[
            F.struct(F.lit(rank).alias("rank"), _matches(text, kind).alias("hits"))
            for rank, kind in enumerate(kinds)
        ]
    )
    rows = docs.select(
        row_key(docs).alias("key"),
        repository.cast("string").alias("repository"),
        owner.cast("string").alias("owner"),
        F.explode(F.filter(found, lambda x: x["hits"].isNotNull())).alias("found"),
    )
    hits = rows.select(
        "key", "repository", "owner", "found.rank", F.posexplode("found.hits").alias("at", "hit")
    ).distinct()
    upto = W.partitionBy("key", "repository", "owner", "rank").orderBy("at")
    end = F.sum(F.col("hit.gap") + F.coalesce("hit.length", F.lit(0))).over(upto)
    placed = hits.withColumn("end", end).filter("hit.length IS NOT NULL")
    least = F.element_at(F.array(*[F.lit(k.least) for k in kinds]), F.col("rank") + 1)
    name = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("rank") + 1)
    return placed.filter(F.length("hit.value") >= least).select(
        "key",
        "repository",
        "owner",
        name.alias("kind"),
        "rank",
        (F.col("end") - F.col("hit.length")).alias("start"),
        "end",
        F.col("hit.value").alias("value"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every value's hash.

    Distinct at each step and combined before each shuffle, so a value that a
    third of the corpus holds sends few rows.
    """
    digest = F.sha2("value", 256).alias("digest")
    unnamed = F.lit("\u0000")
    held = found.select(
        digest,
        F.coalesce("owner", unnamed).alias("owner"),
        F.coalesce("repository", unnamed).alias("repository"),
    ).distinct()
    owners = held.groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("digest").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")
    )


def judged(found: DataFrame, shared_owners: int = SHARED_OWNERS) -> DataFrame:
    """Spans with owners, repositories, verdict (shared, live or plain) and whether to
    mask them: live ones, and short assigned values that few owners have, which the
    keyword tells and not their look.

    ``found`` should be a stored table. The counts are stored too, so the join
    shuffles both sides and adaptive execution can split a value's rows.
    """
    counts = keep(ownership(found), "ownership")
    keyed = found.withColumn("digest", F.sha2("value", 256))
    known = keyed.join(counts, "digest")
    characters = F.size(F.array_distinct(F.split("value", "")))
    looks = (F.length("value") >= LIVE_LENGTH) & (characters >= LIVE_CHARACTERS)
    # One character over and over is a blank to fill in.
    short = (F.col("kind") == "assign") & (F.length("value") < LIVE_LENGTH) & (characters > 1)
    verdict = (
        F.when(F.col("owners") >= shared_owners, "shared").when(looks, "live").otherwise("plain")
    )
    masked = (F.col("verdict") == "live") | ((F.col("verdict") == "plain") & short)
    return known.withColumn("verdict", verdict).withColumn("masked", masked)


def _listed(rows: Column) -> Column:
    """kind:start:end of an array of (start, rank, kind, end), comma-joined in order."""
    named = F.transform(
        F.array_sort(rows),
        lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string")
        ),
    )
    return F.array_join(named, ",")


def report(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document: counts, spans and verdicts."""
    found = keep(spans(docs, repository, owner), "spans")
    place = F.struct("start", "rank", "kind", "end")
    per_key = judged(found).select("key", place.alias("place"), "verdict").distinct()
    base = F.col("place.rank") < len(BASE)
    counts = [
        F.count(F.when(F.col("place.kind") == kind.name, 1)).alias(f"n_{kind.name}")
        for kind in BASE
    ]
    verdicts = [
        F.count(F.when(F.col("verdict") == v, 1)).alias(f"n_{v}") for v in ("live", "shared")
    ]
    grouped = per_key.groupBy("key").agg(
        *counts,
        *verdicts,
        _listed(F.collect_list(F.when(base, F.col("place")))).alias("base"),
        _listed(F.collect_list("place")).alias("spans"),
    )
    rows = docs.select("doc_id", row_key(docs).alias("key")).join(grouped, "key", "left")
    none = F.lit("")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(F.coalesce("base", none), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
        *[F.coalesce(f"n_{v}", F.lit(0)).cast("long").alias(f"n_{v}") for v in ("live", "shared")],
    )


def redact(docs: DataFrame, repository: Column, owner: Column, mark: str = "[secret]") -> DataFrame:
    """The documents with every span that is to be masked replaced by ``mark``.

    Overlapping spans become one mark. Other columns stay, but for ``n_chars``,
    which is counted again where the text changed.
    """
    found = keep(spans(docs, repository, owner), "spans")
    live = judged(found).filter("masked").select("key", "start", "end").distinct()
    inside = W.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(inside.rowsBetween(W.unboundedPreceding, -1))
    opened = live.withColumn("opens", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    merged = (
        opened.withColumn("block", F.sum("opens").over(inside))
        .groupBy("key", "block")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    )
    rows = docs.select(F.struct("*").alias("row"), row_key(docs).alias("key"))
    joined = rows.join(merged, "key", "left")
    text, cuts = F.col("row.text"), F.col("cuts")
    # Kept pieces start where the spans end, and end where the next span starts.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda x: x["end"]))
    ends = F.concat(F.transform(cuts, lambda x: x["start"]), F.array(F.length(text).cast("long")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda x: F.substring(text, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")),
    )
    cleaned = F.when(cuts.isNull(), text).otherwise(F.array_join(pieces, mark))
    changed = {"text": cleaned}
    if "n_chars" in docs.columns:
        old = F.col("row.n_chars")
        changed["n_chars"] = F.when(cuts.isNull(), old).otherwise(F.length(cleaned).cast("long"))
    return joined.select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
