"""Near duplicates by an LSH forest.

Every distinct shingle set has one signature. Each tree of the forest sorts all
signatures by hash values of its own; neighbours in that order share the longest
prefixes. Where sets are sparse the neighbours within reach are all that share
the least prefix; where they are dense the sort itself goes deeper, up to the
whole row of values. So depth follows the region and no bucket has a size limit.
Neighbours are candidates only: a link holds when the full sets confirm it.

1. The next neighbour in a few trees. This joins families of near copies at a
   cost that grows with their size, not its square.
2. All trees. In each region (sets that share the least prefix) every component
   stands once, and components within reach are compared in full: the members of
   the larger in blocks, those of the smaller past each block. Regions of one
   component, as most are by now, fall out.
3. Components with more neighbours than the reach, or cut off from some by the
   border of a sort partition, go again with a much wider reach. Pairs that were
   compared before, and single sets far from the limit by their signatures, are not
   compared again.
4. What is then still dense is searched exactly: sets that may be linked share one
   of their rarest shingles.

Edge cases: a null text reads as empty; an empty set is linked with nothing; a
row without doc_id has no component and takes no part; rows that share a doc_id
share the component; equal sets are linked whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.llm.components import components
from marklens.llm.storage import keep
from marklens.llm.wordhash import SHINGLE, SPACED, buffers, chunks, mix, shingle_sets, words


@dataclass(frozen=True)
class Forest:
    """trees: sort orders; depth: hash values in each; least: values that
    candidates share at least; first_trees: trees of the first round; reach:
    neighbours looked at, each side; widening: factor by which the reach grows in
    the second round; percent: intersection of a link's sets in percent of their
    union; block: members of a component that are held at a time."""

    trees: int = 16
    depth: int = 6
    least: int = 3
    first_trees: int = 4
    reach: int = 4
    widening: int = 8192
    percent: int = 85
    block: int = 256
    shingle: int = SHINGLE

    @property
    def estimate(self) -> float:
        """Share of equal values below which no link is expected: five standard
        deviations under the limit."""
        p = self.percent / 100
        return p - 5 * (p * (1 - p) / (self.trees * self.depth)) ** 0.5


DEFAULT = Forest()

_SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, n + 1, dtype=np.uint64)
    return mix(at), mix(at + np.uint64(1 << 32)) | np.uint64(1)


def _least_values(found: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, in 32 bits."""
    low = np.full(len(flips), ~np.uint64(0))
    for i in range(0, len(found), 2048):
        part = found[i : i + 2048, None]
        np.minimum(low, ((part ^ flips) * factors).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _sets(column: pa.Array, forest: Forest) -> Iterator[np.ndarray]:
    data, offsets = buffers(column)
    for low, high in chunks(offsets):
        yield from shingle_sets(words(data, offsets[low : high + 1], SPACED), forest.shingle)


def _sign(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    flips, factors = _seeds(forest.trees * forest.depth)
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for found in _sets(batch.column("text"), forest):
            sizes.append(len(found))
            some = len(found) > 0
            digests.append(blake2b(found, digest_size=16).digest() if some else None)
            # Big-endian, so that bytes sort as the values do.
            values = _least_values(found, flips, factors) if some else None
            signatures.append(values.astype(">u4").tobytes() if some else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "digest", "signature"],
        )


def signatures(docs: DataFrame, forest: Forest = DEFAULT) -> DataFrame:
    """Set size, digest of the set and minimum hash values of every row."""
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(partial(_sign, forest=forest), _SIGNED)


def _neighbours(
    batches: Iterator[pa.RecordBatch], forest: Forest, reach: int, estimate: bool, once: bool
) -> Iterator[pa.RecordBatch]:
    """Pairs of components that stand within reach in the sorted order.

    ``candidate``: a pair whose set sizes allow a link. ``dense``: the component, without
    b, has a neighbour at full reach, so there may be more beyond. ``estimate``: signatures are there; two
    single sets far below the limit by them are left out. ``once``: such a pair is
    told only in the first tree where it shares a region; were it beyond reach there,
    both sets would be dense or at a border. The last rows of a batch
    are carried over to the next one. Rows within reach of the partition's border
    come with their region as ``edge`` and without b.
    """
    part = TaskContext.get().partitionId()
    head: list[tuple[int, bytes]] = []
    width = 4 * forest.depth
    fields = ("component", "size", "n_min", "n_max", "tree")
    carried = None
    for batch in batches:
        new = batch.num_rows
        if not new:
            continue
        columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in fields]
        paths = b"".join(batch.column("path").to_pylist())
        columns.append(np.frombuffer(paths, np.uint8).reshape(-1, width)[:, : 4 * forest.least])
        if len(head) < reach:
            more = min(reach - len(head), new)
            head += _regions(columns[0][:more], columns[4][:more], columns[5][:more])
        if estimate:
            whole = b"".join(batch.column("signature").to_pylist())
            columns.append(np.frombuffer(whole, ">u4").reshape(new, -1))
        if carried is not None:
            columns = [np.concatenate(x) for x in zip(carried, columns, strict=True)]
        ids, members, low_n, high_n, trees, keys = columns[:6]
        old = len(ids) - new
        for step in range(1, min(reach, len(ids) - 1) + 1):
            # Pairs wholly among the carried rows were seen before.
            low = max(0, old - step)
            a, b = slice(low, len(ids) - step), slice(low + step, len(ids))
            near = np.flatnonzero((trees[a] == trees[b]) & (keys[a] == keys[b]).all(axis=1)) + low
            if not len(near):
                break  # neighbours further off share no more
            a, b = near, near + step
            least = np.maximum(low_n[a], low_n[b])
            fresh = 100 * np.minimum(high_n[a], high_n[b]) >= forest.percent * least
            fresh &= ids[a] != ids[b]
            if estimate:
                single = fresh & (members[a] == 1) & (members[b] == 1)
                same = columns[6][a[single]] == columns[6][b[single]]
                likely = same.mean(axis=1) >= forest.estimate
                if once:
                    paths = same.reshape(len(same), forest.trees, forest.depth)
                    met = paths[:, :, : forest.least].all(axis=2)
                    likely &= met.argmax(axis=1) == trees[a[single]]
                fresh[single] = likely
            if step == reach:
                full = np.unique(np.concatenate([ids[a], ids[b]]))
                yield _found(full, None, False, True)
            pair = np.stack([ids[a[fresh]], ids[b[fresh]]], axis=1)
            pair = np.unique(np.sort(pair, axis=1), axis=0)
            yield _found(pair[:, 0], pair[:, 1], True, False)
        carried = [x[-reach:].copy() for x in columns]
    if carried is not None:
        # Only the regions of the first and the last row can go on beyond the border.
        tail = _regions(carried[0], carried[4], carried[5])
        rows = [x for x in head if x[1] == head[0][1]] + [x for x in tail if x[1] == tail[-1][1]]
        rows = list(dict.fromkeys(rows))
        ids = np.array([x[0] for x in rows], np.int64)
        yield _found(ids, None, False, False, [x[1] for x in rows], part)


def _found(
    a: np.ndarray,
    b: np.ndarray | None,
    candidate: bool,
    dense: bool,
    edge: list[bytes] | None = None,
    part: int | None = None,
) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a, pa.int64()),
            pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()),
            pa.array(np.full(n, candidate)),
            pa.array(np.full(n, dense)),
            pa.nulls(n, pa.binary()) if edge is None else pa.array(edge, pa.binary()),
            pa.nulls(n, pa.int32()) if part is None else pa.array(np.full(n, part), pa.int32()),
        ],
        names=["a", "b", "candidate", "dense", "edge", "part"],
    )


def _regions(ids: np.ndarray, trees: np.ndarray, keys: np.ndarray) -> list[tuple[int, bytes]]:
    return [(i, bytes([t]) + k.tobytes()) for i, t, k in zip(ids.tolist(), trees.tolist(), keys, strict=True)]


def _rows(sets: DataFrame, trees: int, forest: Forest) -> DataFrame:
    """A row per set and tree, with its path there and the region's hash."""
    width = 4 * forest.depth
    paths = F.expr(
        f"transform(sequence(0, {trees - 1}), "
        f"t -> struct(t AS tree, substring(signature, 1 + t * {width}, {width}) AS path))"
    )
    rows = sets.select("doc_id", "n_shingles", F.explode(paths).alias("at"))
    region = F.xxhash64("at.tree", F.expr(f"substring(at.path, 1, {4 * forest.least})"))
    return rows.select("doc_id", "n_shingles", "at.tree", "at.path", region.alias("region"))


def _perhaps(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose value is among ``keys`` (one column), and a few others.

    The keys' hashes set bits in a map of fixed size, which is broadcast, so that
    the other rows need not be shuffled to find out. An exact join follows.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << 26))
    keys = keys.toDF(column).select(place.alias("bit"))
    maps = keys.groupBy(F.bitmap_bucket_number("bit").alias("bit_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bit_map")
    )
    found = rows.select(F.struct("*").alias("row"), F.col(column)).withColumn("bit", place)
    found = found.join(F.broadcast(maps), F.bitmap_bucket_number("bit") == F.col("bit_bucket"))
    found = found.withColumn("at", F.bitmap_bit_position("bit"))
    byte = F.expr("cast(conv(hex(substring(bit_map, cast(at div 8 AS int) + 1, 1)), 16, 10) AS int)")
    is_set = F.expr("shiftright(byte, cast(at % 8 AS int)) % 2 = 1")
    return found.withColumn("byte", byte).filter(is_set).select("row.*")


def neighbours(
    rows: DataFrame, reach: int, forest: Forest, estimate: bool = False, once: bool = False
) -> DataFrame:
    """Pairs (a < b) of neighbouring components, as (a, b, candidate, dense, edge, part).

    The sort splits a dense region over as many partitions as it needs.
    Neighbours on either side of a partition border miss each other; rows with
    ``edge`` tell where that can be, see ``crowded``.
    """
    order = ("tree", "path", "component")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    pairs = ordered.mapInArrow(
        partial(_neighbours, forest=forest, reach=reach, estimate=estimate, once=once),
        "a long, b long, candidate boolean, dense boolean, edge binary, part int",
    )
    return pairs.groupBy("a", "b", "edge", "part").agg(
        F.max("candidate").alias("candidate"), F.max("dense").alias("dense")
    )


def crowded(pairs: DataFrame) -> DataFrame:
    """Components (a) that may have neighbours which ``pairs``, stored, lacks: at full
    reach, or at a border in a region that goes on in another partition."""
    dense = pairs.filter("dense").select("a")
    edges = pairs.filter("edge IS NOT NULL")
    cut = edges.groupBy("edge").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    beside = edges.join(cut.filter("low < high"), "edge", "left_semi").select("a")
    return dense.union(beside).distinct()


def first_pairs(sets: DataFrame, forest: Forest = DEFAULT) -> DataFrame:
    """Each set with its next neighbour in the first trees."""
    rows = _rows(sets, forest.first_trees, forest).select(
        F.col("doc_id").alias("component"),
        F.lit(1).cast("long").alias("size"),
        F.col("n_shingles").alias("n_min"),
        F.col("n_shingles").alias("n_max"),
        "tree",
        "path",
    )
    return neighbours(rows, 1, forest)


def shared_regions(sets: DataFrame, forest: Forest = DEFAULT) -> DataFrame:
    """The rows of all trees that share their region with another set; few do."""
    rows = _rows(sets, forest.trees, forest)
    shared = (
        rows.groupBy("region")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("region")
    )
    shared = keep(shared, "regions")
    return _perhaps(rows, "region", shared).join(shared, "region", "left_semi")


def region_pairs(
    rows: DataFrame,
    labels: DataFrame,
    reach: int,
    forest: Forest = DEFAULT,
    sets: DataFrame | None = None,
    first_tree: bool = False,
) -> DataFrame:
    """Components that meet in a region of any tree, within reach.

    Regions with one component are left out by their smallest and greatest
    component; in the others each component has one row, with the range of its set
    sizes there. ``sets`` gives signatures to estimate likeness by. ``first_tree``: a
    pair of single sets comes from one tree instead of all that bring it together.
    """
    rows = keep(_with_component(rows, labels), "rows")
    mixed = (
        rows.groupBy("region")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
    )
    once = (
        rows.join(mixed, "region", "left_semi")
        .groupBy("tree", "region", "component")
        .agg(
            F.min("n_shingles").alias("n_min"),
            F.max("n_shingles").alias("n_max"),
            F.min(F.struct("path", "doc_id")).alias("first"),
        )
        .join(_sizes(labels), "component", "left")
    )
    once = once.select(
        "component",
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
        "n_min",
        "n_max",
        "tree",
        "first.path",
        F.col("first.doc_id").alias("doc_id"),
    )
    if sets is not None:
        once = keep(once, "rows")
        known = _perhaps(sets.select("doc_id", "signature"), "doc_id", once.select("doc_id"))
        known = known.groupBy("doc_id").agg(F.first("signature").alias("signature"))
        once = once.join(known, "doc_id")
    return neighbours(once.drop("doc_id"), reach, forest, sets is not None, first_tree)


def _compare(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    """Links, from rows (base, block, side, doc_id, text) in this order: the
    members of a block first, then the documents asked against them."""
    seeds = _seeds(forest.trees * forest.depth)
    block, ids, sets, signs = None, [], [], None
    for batch in batches:
        links = []
        fields = ("base", "block", "side", "doc_id")
        columns = [batch.column(x).to_pylist() for x in fields]
        for base, number, side, doc, found in zip(
            *columns, _sets(batch.column("text"), forest), strict=True
        ):
            if (base, number) != block:
                block, ids, sets, signs = (base, number), [], [], None
            if not side:
                ids.append(doc)
                sets.append(found)
                continue
            if not len(found) or not sets:
                continue
            likely = range(len(sets))
            if len(sets) > 1:
                if signs is None:
                    signs = np.stack([_least_values(x, *seeds) for x in sets])
                alike = (signs == _least_values(found, *seeds)).mean(axis=1)
                likely = np.argsort(-alike, kind="stable")[: int((alike >= forest.estimate).sum())]
            for i in likely:
                other = sets[i]
                small, large = sorted((other.size, found.size))
                if 100 * small < forest.percent * large:
                    continue
                both = np.intersect1d(other, found, assume_unique=True).size
                if both and 100 * both >= forest.percent * (small + large - both):
                    links.append((ids[i], doc))
                    break  # one link joins the two components
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )


def _with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = rows.join(labels, F.col("doc_id") == F.col("id"), "left").drop("id")
    return known.withColumn("component", F.coalesce("label", "doc_id")).drop("label")


def _sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy(F.col("label").alias("component")).agg(F.count("*").alias("size"))


def confirmed(
    pairs: DataFrame, docs: DataFrame, labels: DataFrame | None = None, forest: Forest = DEFAULT
) -> DataFrame:
    """Links (a, b) between the components of each pair, one or more if there are any.

    A component without labels is the document of its id. The larger component is
    the base: each member goes to one block of it. The documents of the smaller go
    to every block. So a text is sent once for each component that it is compared
    with, or block of it, and pairs of documents are never listed.
    """
    if labels is None:
        one = F.lit(0).cast("long").alias("block")
        own = pairs.select(F.col("a").alias("base"), one, F.lit(0).alias("side"), F.col("a").alias("doc_id"))
        asked = pairs.select("a", one, F.lit(1), "b")
    else:
        sizes = _sizes(labels)
        known = pairs.join(sizes.toDF("a", "size_a"), "a", "left")
        known = known.join(sizes.toDF("b", "size_b"), "b", "left").fillna(1, ["size_a", "size_b"])
        swap = F.col("size_a") >= F.col("size_b")
        sides = known.select(
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("base"),
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("other"),
            F.ceil(F.greatest("size_a", "size_b") / forest.block).alias("blocks"),
        )
        sides = keep(sides, "sides")
        bases = sides.select("base", "blocks").distinct()
        member = F.coalesce("id", "base").alias("doc_id")
        own = bases.join(labels, F.col("base") == F.col("label"), "left").select(
            "base",
            F.pmod(F.xxhash64(F.coalesce("id", "base")), F.col("blocks")).cast("long").alias("block"),
            F.lit(0).alias("side"),
            member,
        )
        asked = sides.join(labels, F.col("other") == F.col("label"), "left").select(
            "base",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            F.lit(1).alias("side"),
            F.coalesce("id", "other").alias("doc_id"),
        )
    places = keep(own.union(asked).distinct(), "places")
    texts = _perhaps(docs.select("doc_id", "text"), "doc_id", places.select("doc_id"))
    sent = places.join(texts.withColumnRenamed("doc_id", "text_id"), F.col("doc_id") == F.col("text_id"))
    met = sent.drop("text_id").repartition("base", "block")
    met = met.sortWithinPartitions("base", "block", "side", "doc_id")
    return met.mapInArrow(partial(_compare, forest=forest), "a long, b long")


def _shingles(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(_sets(batch.column("text"), forest))
        ends = pa.array(np.cumsum([0] + [len(x) for x in sets]), pa.int32())
        every = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("set"),
                batch.column("component"),
                pa.ListArray.from_arrays(ends, pa.array(every)),
            ],
            names=["set", "component", "shingles"],
        )


def exact_pairs(
    rows: DataFrame, labels: DataFrame, docs: DataFrame, forest: Forest = DEFAULT
) -> DataFrame:
    """Pairs (a < b) of the rows' components that can have a link, none left out.

    Shingles are ordered by the number of sets that hold them. The first one that
    two linked sets share stands among the first of either, as far in as the
    limit allows: ``asked`` places for any set, fewer, ``first`` places, for the
    smaller of the two. A component has one row per shingle, set size and place
    class, so families don't list pairs of their own.
    """
    p = forest.percent
    members = keep(_with_component(rows.select("doc_id").distinct(), labels), "members")
    texts = _perhaps(docs.select("doc_id", "text"), "doc_id", members.select("doc_id"))
    texts = texts.join(members, "doc_id").select(
        F.xxhash64("text").alias("set"), "component", "text"
    )
    sets = texts.mapInArrow(
        partial(_shingles, forest=forest), "set long, component long, shingles array<long>"
    )
    # Equal texts of a component count once.
    sets = keep(sets.dropDuplicates(["set", "component"]), "shingles")
    single = sets.select("set", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    held = single.groupBy("shingle").agg(
        F.count("*").alias("held"),
        (F.min("component") < F.max("component")).alias("mixed"),
    )
    ordered = (
        single.join(held, "shingle")
        .groupBy("set", "component", "n")
        .agg(F.array_sort(F.collect_list(F.struct("held", "shingle", "mixed"))).alias("ordered"))
    )
    first = F.expr(f"n - (2 * {p} * n + {99 + p}) div {100 + p} + 1")
    asked = F.expr(f"n - ({p} * n + 99) div 100 + 1")
    rare = ordered.select(
        "component", "n", first.alias("first"), F.posexplode(F.slice("ordered", F.lit(1), asked.cast("int"))).alias("at", "x")
    ).filter("x.mixed")
    rare = rare.groupBy(F.col("x.shingle").alias("shingle"), "component", "n").agg(
        F.min("at").alias("at"), F.max(F.col("at") < F.col("first")).alias("small")
    )
    rare = keep(rare, "rare")
    small = rare.filter("small").select("shingle", F.col("component").alias("a"), F.col("n").alias("na"), F.col("at").alias("at_a"))
    large = rare.select("shingle", F.col("component").alias("b"), F.col("n").alias("nb"), F.col("at").alias("at_b"))
    enough = f"(100 + {p}) * (1 + least(na - 1 - at_a, nb - 1 - at_b)) >= {p} * (na + nb)"
    met = small.join(large, "shingle").filter(f"a <> b AND na <= nb AND 100 * na >= {p} * nb AND {enough}")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, forest: Forest = DEFAULT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, itself included;
    the document that bears it is kept. Rows without doc_id have neither.
    """
    signed = keep(signatures(docs, forest), "signatures")
    usable = signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    # One row per set; combined before the shuffle, so copies cost little.
    sets = usable.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    sets = keep(sets, "sets")
    # A doc_id on several rows ties their sets together, and copies their ids.
    firsts = sets.select("digest", F.col("doc_id").alias("first_id"))
    copies = usable.select("digest", "doc_id").join(firsts, "digest").filter("doc_id <> first_id")
    pairs = keep(first_pairs(sets, forest), "pairs").filter("candidate").select("a", "b")
    found = confirmed(pairs, docs, forest=forest)
    labels = components(keep(found.union(copies.select("first_id", "doc_id")), "found"))
    rows = keep(shared_regions(sets, forest), "shared")
    asked, changed = None, None
    for reach in (forest.reach, forest.reach * forest.widening):
        # With little reach every tree counts; later one tells each pair.
        pairs = keep(region_pairs(rows, labels, reach, forest, sets, asked is not None), "pairs")
        new = pairs.filter("candidate").select("a", "b")
        if asked is not None:
            # What was compared before has no link, unless a side has grown since.
            same = asked.join(changed.toDF("a"), "a", "left_anti").join(changed.toDF("b"), "b", "left_anti")
            new = new.join(same, ["a", "b"], "left_anti")
        asked = keep(new, "asked")
        found = keep(confirmed(asked, docs, labels, forest), "found")
        dense = _with_component(rows, labels).join(
            crowded(pairs), F.col("component") == F.col("a"), "left_semi"
        )
        rows = keep(dense.drop("component"), "dense")
        if not found.isEmpty():
            labels = components(found, labels)
        if rows.isEmpty():
            break
        grown = found.select(F.explode(F.array("a", "b")).alias("id")).join(labels, "id", "left")
        changed = keep(grown.select(F.coalesce("label", "id").alias("label")).distinct(), "changed")
    else:
        asked = keep(exact_pairs(rows, labels, docs, forest), "exact")
        found = keep(confirmed(asked, docs, labels, forest), "found")
        labels = components(found, labels)
    rows = signed.drop("signature", "digest").join(
        labels, F.col("doc_id") == F.col("id"), "left"
    )
    component = F.coalesce("label", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )
