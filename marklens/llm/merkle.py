"""Merkle manifest of a table with proofs by pointer jumping.

Every row is a leaf. The leaves of a source, in the order of their ids, are hashed
in runs of ``FANOUT`` level by level until one hash is left, the source's subroot;
the subroots, in the order of the sources, are hashed likewise into the root.

A run points at the run that holds the hash made from it and keeps a segment of its
way up: what stands left and right of its hash there. Joining the runs with
themselves appends to each segment the one of the run it points at and doubles the
distance, so a few joins bring all runs to the root, however tall the trees are.
Each leaf then joins its own run.

At scale: only digests are sorted and shuffled, never texts. Places are counted per
sort partition, so that no task numbers a whole source. At distance d a run is
pointed at by up to 16**d others; from distance 4 on both sides of the join bear a
salt, which keeps 256 to a value.

Edge cases: a null field is hashed as "-"; rows without doc_id come first in their
source; rows of one doc_id stand in the order of their leaves, equal rows are leaves
of their own; a null source is a source, the first; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marklens.llm.storage import keep

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the subroots; sources are numbered from 0.
_TOP = -1
_ROW_BITS = 33


def _field(value: Column) -> Column:
    text = value.cast("string")
    marked = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(marked, F.lit("-"))


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """Key of the source, doc_id, leaf, and the leaf that a tampered row would have:
    null where the row is not one of those tampered with."""
    fields = {c: _field(F.col(c)) for c in FIELDS}
    changed = fields | {"text": _field(F.translate("text", _UPPER, _LOWER))}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        # Null before all other sources, and never null itself.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("site"),
        "doc_id",
        _digest(*fields.values()).alias("leaf"),
        F.when(tampered, _digest(*changed.values())).alias("tampered"),
    )


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with their place, from 0, in the order of all rows.

    Sort partitions are written with the row's number inside; the counts of the
    partitions before are added from a table with a row per partition.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = keep(ordered.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", _ROW_BITS).alias("part")
    counts = at.groupBy(part).agg(F.count("*").alias("rows"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    inside = F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = at.withColumn("part", part).join(F.broadcast(starts), "part")
    return placed.withColumn("position", F.col("start") + inside).drop("at", "part", "start")


def _levels(count: int) -> int:
    """Hashings until one node is left of so many."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FANOUT), levels + 1
    return levels


_RUN = ("tree", "level", "run")


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes in runs, each with the hash made from it; a lone node has none."""
    members = F.sort_array(F.collect_list(F.struct("place", "hash")))["hash"]
    run = F.floor(F.col("place") / FANOUT).cast("long").alias("run")
    grouped = nodes.filter("width > 1").groupBy("tree", "width", run).agg(members.alias("members"))
    return grouped.select(
        "tree",
        F.lit(level).alias("level"),
        "run",
        "width",
        "members",
        F.sha2(F.concat_ws("", "members"), 256).alias("hash"),
    )


def _above(runs: DataFrame) -> DataFrame:
    """The nodes that runs make: one level up, a sixteenth as many."""
    return runs.select(
        "tree",
        F.col("run").alias("place"),
        "hash",
        F.ceil(F.col("width") / FANOUT).cast("long").alias("width"),
    )


def _tree(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, and the one node that is left of each tree."""
    found, left = [], nodes.filter("width = 1")
    for level in range(levels):
        runs = keep(_runs(nodes, level), f"{name}-{level}")
        found.append(runs)
        nodes = _above(runs)
        left = left.unionByName(nodes.filter("width = 1"))
    return found, left.select("tree", "hash")


def _key(tree: Column, level: Column, run: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), run.cast("long").alias("run"))


def _seat(tree: Column, level: Column, place: Column) -> Column:
    """Where a node stands: its run and its place in the run."""
    run = F.floor(place / FANOUT).cast("long")
    return F.struct(_key(tree, level, run).alias("run"), (place % FANOUT).cast("int").alias("at"))


def _entry(key: Column, members: Column, at: Column) -> Column:
    """A step of a proof: what stands left and right of the node in its run, and the
    node itself where it is a subroot."""
    top = (key["tree"] == _TOP) & (key["level"] == 0)
    return F.struct(
        F.concat_ws("", F.slice(members, F.lit(1), at)).alias("left"),
        F.concat_ws("", F.slice(members, at + 2, F.lit(FANOUT))).alias("right"),
        F.when(top, F.get(members, at)).alias("subroot"),
    )


def _jumped(paths: DataFrame, distance: int) -> DataFrame:
    """Append to each segment that of the run it points at; rows at the end stay."""
    salts = FANOUT ** max(distance - 2, 0) if distance >= 4 else 1
    going, done = paths.filter("goal.tree IS NOT NULL"), paths.filter("goal.tree IS NULL")
    salt = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
    left = going.select(
        F.col("key").alias("own"),
        "members",
        F.col("goal").alias("key"),
        F.col("steps").alias("first"),
        salt.alias("salt"),
    )
    targets = left.select("key").distinct()
    right = paths.drop("members").join(targets, "key", "left_semi").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    longer = left.join(right, ["key", "salt"]).select(
        F.col("own").alias("key"), "goal", F.concat("first", "steps").alias("steps"), "members"
    )
    return longer.unionByName(done)


def proofs(docs: DataFrame) -> DataFrame:
    """For every row its leaf, subroot, root and proof: the steps from the leaf up,
    each with the digests left and right; and the root folded from the tampered leaf,
    or where the row isn't tampered with from its own."""
    ordered = positions(leaves(docs), ["site", "doc_id", "leaf"], "merkle-leaves")
    sites = ordered.groupBy("site").agg(F.min("position").alias("first"), F.count("*").alias("width"))
    numbered = positions(sites, ["site"], "merkle-sites").withColumnRenamed("position", "tree")
    numbered = keep(numbered, "merkle-trees")
    tallest, n_sites = numbered.agg(F.max("width"), F.count("*")).first()
    if not n_sites:
        return docs.sparkSession.createDataFrame([], _PROOF_SCHEMA)
    levels, top_levels = _levels(tallest), _levels(n_sites)

    placed = ordered.join(numbered, "site").withColumn("place", F.col("position") - F.col("first"))
    nodes = placed.select("tree", "place", F.col("leaf").alias("hash"), "width")
    runs, subroots = _tree(nodes, levels, "merkle-runs")
    tops = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        "hash",
        F.lit(n_sites).cast("long").alias("width"),
    )
    top_runs, last = _tree(tops, top_levels, "merkle-top")
    root = last.first()["hash"]

    every = _root_seats([*runs, *top_runs], n_sites)
    paths = _closed(every, levels + top_levels)
    seat = F.when(F.col("width") > 1, _seat(F.col("tree"), F.lit(0), F.col("place")))
    if n_sites > 1:
        seat = seat.otherwise(_seat(F.lit(_TOP), F.lit(0), F.col("tree")))
    seated = placed.select("doc_id", "leaf", "tampered", seat.alias("seat"))
    found = seated.withColumn("key", F.col("seat.run"))
    if paths is not None:
        found = found.join(paths.drop("goal"), "key", "left")
        own = _entry(F.col("key"), F.col("members"), F.col("seat.at"))
        steps = F.when(F.col("members").isNotNull(), F.concat(F.array(own), "steps"))
    else:
        steps = F.lit(None).cast(_STEPS)
    found = found.select("doc_id", "leaf", "tampered", F.coalesce(steps, F.array().cast(_STEPS)).alias("proof"))
    named = F.filter("proof", lambda step: step["subroot"].isNotNull())
    start = F.coalesce("tampered", "leaf")
    return found.select(
        "doc_id",
        "leaf",
        F.coalesce(F.get(named, F.lit(0))["subroot"], F.lit(root)).alias("subroot"),
        F.lit(root).alias("root"),
        "proof",
        folded(start, F.col("proof")).alias("folded_root"),
    )


_STEPS = "array<struct<left: string, right: string, subroot: string>>"
_PROOF_SCHEMA = f"doc_id long, leaf string, subroot string, root string, proof {_STEPS}, folded_root string"


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256)
    )


def _root_seats(runs: list[DataFrame], n_sites: int) -> DataFrame | None:
    """All runs, each with the seat of the hash made from it; the last has none."""
    if not runs:
        return None
    every = runs[0]
    for more in runs[1:]:
        every = every.unionByName(more)
    last = F.col("width") <= FANOUT
    inside = _seat(F.col("tree"), F.col("level") + 1, F.col("run"))
    over = F.when((F.col("tree") != _TOP) & (F.lit(n_sites) > 1), _seat(F.lit(_TOP), F.lit(0), F.col("tree")))
    seat = F.when(last, over).otherwise(inside)
    key = _key(F.col("tree"), F.col("level"), F.col("run"))
    return every.select(key.alias("key"), seat.alias("seat"), "members")


def _closed(every: DataFrame | None, height: int) -> DataFrame | None:
    """Every run with all steps from it to the root."""
    if every is None:
        return None
    heads = every.select(F.col("key").alias("up"), F.col("members").alias("there"))
    seated = every.withColumn("up", F.col("seat.run"))
    step = _entry(F.col("up"), F.col("there"), F.col("seat.at"))
    first = seated.filter("up.tree IS NOT NULL").join(heads, "up")
    nothing = F.lit(None).cast("struct<tree: long, level: int, run: long>")
    # goal: the last run in the steps, until there is none above it.
    paths = first.select("key", F.col("up").alias("goal"), F.array(step).alias("steps"), "members")
    ends = seated.filter("up.tree IS NULL").select(
        "key", nothing.alias("goal"), F.array().cast(_STEPS).alias("steps"), "members"
    )
    paths = keep(paths.unionByName(ends), "merkle-paths")
    distance = 1
    while distance < height:
        paths = keep(_jumped(paths, distance), "merkle-paths")
        distance *= 2
    return paths


def report(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, digest of the proof, folded root and whether it is the root."""
    found = proofs(docs)
    siblings = F.transform("proof", lambda step: F.concat(step["left"], step["right"]))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
