"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so a question asked anew with
other values reads the same. Every window of canonical words of every text is
joined by its hash to the windows of the benchmark items. Matches on one diagonal
(place in the text less place in the item) belong together, and so do those on
consistent diagonals beside each other. They count only if the slots are
consistent: where an item repeats a value, the text repeats one too. A number with
its points, commas, slashes and colons is one value, and so are the words of a name.

An item with fewer words than a window, or without a window of enough plain words,
is found where its words stand as they are, all of them and in this order. An item of
fewer than ``Windows.short`` words ("Paris") is ordinary text elsewhere: it counts only
if it is the whole text, and is a mention where it stands in a longer one.

Edge cases: a null text reads as empty; an item without a word can't be found; equal
rows have equal results; a text without a match is clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marklens.llm.storage import keep
from marklens.llm.wordhash import PLAIN, Words, buffers, chunks, grams, words

#: Words that say what a number counts; with a number before them they are units.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg ton tons ounce ounces pound "
    "pounds l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years dollar dollars cent cents euro euros percent "
    "degrees mph kph"
).split()

#: Windows of a benchmark up to which they are broadcast.
SENT = 200_000

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (1, 2, 3))


@dataclass(frozen=True)
class Windows:
    """words: in a window; plain: of them that aren't placeholders, at least;
    aligned: matched windows on a diagonal that show a passage; share: of an
    item's windows that do so for a short item; drift: of diagonals that are added
    up, from one to the next at most; short: words below which an item within a longer
    text is a mention."""

    words: int = 6
    plain: int = 3
    aligned: int = 8
    share: float = 0.6
    drift: int = 3
    short: int = 1


DEFAULT = Windows()
#: Of the query and the pipeline: items of one or two words are mentions in longer texts.
PRODUCTION = Windows(short=3)


def _kinds(w: Words, units: np.ndarray) -> np.ndarray:
    """Placeholder of each word, 0 for a plain word.

    A number has a digit. A name starts with a capital inside a sentence and goes
    on without one. A unit follows a number.
    """
    kinds = np.zeros(len(w.hashes), np.uint64)
    if not len(kinds):
        return kinds
    digits = np.concatenate([[0], np.cumsum((w.data >= 0x30) & (w.data <= 0x39))])
    number = digits[w.ends] > digits[w.starts]
    initial = w.data[w.starts]
    second = w.data[np.minimum(w.starts + 1, len(w.data) - 1)]
    capital = (initial >= 0x41) & (initial <= 0x5A) & ~((second >= 0x41) & (second <= 0x5A))
    stops = np.isin(w.data, np.frombuffer(b".!?:\n\"|", np.uint8))
    stops = np.concatenate([[0], np.cumsum(stops)])
    opening = np.ones(len(kinds), bool)
    opening[1:] = stops[w.starts[1:]] > stops[w.ends[:-1]]
    firsts = w.first[:-1][np.diff(w.first) > 0]
    opening[firsts] = True
    kinds[capital & ~opening] = _NAME
    after = np.zeros(len(kinds), bool)
    after[1:] = number[:-1]
    after[firsts] = False
    kinds[after & np.isin(w.hashes, units)] = _UNIT
    kinds[number] = _NUMBER
    return kinds


def _runs(w: Words, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, placeholders and rows' first places with each run of words that is one
    value as one word: digits around a point, comma, slash or colon, or the words of a
    name."""
    n = len(kinds)
    if not n:
        return w.hashes, kinds, w.first
    joins = np.zeros(n, bool)
    gap = w.starts[1:] - w.ends[:-1]
    between = w.data[w.ends[:-1]]
    digit = (w.data >= 0x30) & (w.data <= 0x39)
    inside = digit[w.ends[:-1] - 1] & digit[w.starts[1:]] & np.isin(between, np.frombuffer(b",./:", np.uint8))
    name = (kinds[1:] == _NAME) & (kinds[:-1] == _NAME) & np.isin(between, [0x20, 0x27, 0x2D])
    joins[1:] = (gap == 1) & (inside | name)
    joins[w.first[:-1][np.diff(w.first) > 0]] = False
    heads = np.flatnonzero(~joins)
    place = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
    steps = np.full(place.max() + 1, 0xD6E8FEB86659FD93, np.uint64)
    steps[0] = 1
    hashes = np.add.reduceat(w.hashes * np.multiply.accumulate(steps)[place], heads)
    return hashes, kinds[heads], np.searchsorted(heads, w.first)


def _folded(data: np.ndarray) -> np.ndarray:
    """Accented capitals of two bytes (Latin-1) as small letters; A-Z stay."""
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    lead = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    data = data.copy()
    data[lead] += 0x20
    return data


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer("\n".join(UNITS).encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]), PLAIN).hashes


def _windows(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    """For each text the canonical hash of every window, and the words behind its
    placeholders in order, each with the placeholder's kind in the two lowest bits."""
    units, size = _unit_hashes(), windows.words
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        data = _folded(data)
        for low, high in chunks(offsets):
            w = words(data, offsets[low : high + 1], PLAIN)
            hashes, kinds, first = _runs(w, _kinds(w, units))
            every = grams(np.where(kinds > 0, kinds, hashes), size)
            counts = np.diff(first)
            n = np.maximum(counts - size + 1, 0)
            left = np.repeat(first[1:], counts) - np.arange(len(hashes))
            inside = left[: len(every)] >= size
            plain = np.concatenate([[0], np.cumsum(kinds == 0)])
            values = (hashes & ~np.uint64(3)) | kinds
            ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            known = len(every)
            if known:
                held = sliding_window_view(kinds > 0, size)[inside]
                slots = sliding_window_view(values, size)[inside][held].view(np.int64)
                counted = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
            else:
                slots, counted = np.zeros(0, np.int64), np.zeros(1, np.int64)
            columns = [
                pa.array(every[inside].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(counted, pa.int32()), pa.array(slots)),
                pa.array((plain[size:] - plain[:-size])[inside].astype(np.int8) if known else [], pa.int8()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(low, high - low)]
                + [pa.ListArray.from_arrays(ends, c) for c in columns],
                names=["id", "windows", "slots", "plain"],
            )


def canonical(rows: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """Windows of every text of (id, text), as arrays."""
    return rows.select("id", "text").mapInArrow(
        partial(_windows, windows=windows),
        "id long, windows array<long>, slots array<array<long>>, plain array<tinyint>",
    )


def _literal(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """A row per run of each number of words as they stand, and the text's words."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for low, high in chunks(offsets):
            w = words(data, offsets[low : high + 1], PLAIN)
            counts = np.diff(w.first)
            ids = batch.column("id").slice(low, high - low)
            left = np.repeat(w.first[1:], counts) - np.arange(len(w.hashes))
            for size in sizes:
                every = grams(w.hashes, size)
                at = np.flatnonzero(left[: len(every)] >= size)
                row = w.rows[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row)),
                        pa.array(np.full(len(at), size), pa.int32()),
                        pa.array(at - w.first[row], pa.int32()),
                        pa.array(every[at].view(np.int64)),
                        pa.array(counts[row], pa.int32()),
                    ],
                    names=["id", "size", "at", "window", "words"],
                )


def literal(rows: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Runs of words of every text of (id, text)."""
    return rows.select("id", "text").mapInArrow(
        partial(_literal, sizes=sizes), "id long, size int, at int, window long, words int"
    )


def _sent(stored: DataFrame) -> DataFrame:
    """A stored table marked for broadcast if it is small by its rows."""
    return F.broadcast(stored) if stored.count() <= SENT else stored


def _literal_matches(
    docs: DataFrame, benchmark: DataFrame, usable: DataFrame, windows: Windows
) -> DataFrame | None:
    """Items without usable windows where they stand whole, as in ``matches``; None
    without such items. A longer item is cut into runs of a window's words, which
    must all stand on one diagonal."""
    known = _items(benchmark)
    short = known.join(usable.select("item").distinct(), "item", "left_anti").select(F.col("item").alias("id"), "text")
    runs = literal(short, tuple(range(1, windows.words + 1))).filter(
        F.col("size") == F.least("words", F.lit(windows.words))
    )
    sizes = sorted(r["size"] for r in runs.select("size").distinct().collect())
    if not sizes:
        return None
    items = runs.select(
        F.col("id").alias("item"),
        "size",
        F.col("at").alias("item_at"),
        "window",
        "words",
        (F.col("words") - F.col("size") + 1).alias("in_item"),
    ).join(known.select("item", "item_id"), "item")
    rows = docs.select(row_key(docs).alias("id"), "text")
    items = _sent(keep(items, "literal"))
    texts = literal(rows, tuple(sizes)).withColumnRenamed("words", "text_words")
    met = texts.join(items, ["size", "window"])
    longer = (F.col("words") < windows.short) & (F.col("text_words") > F.col("words"))
    lined = met.groupBy(
        F.col("id").alias("key"), "item", "item_id", "in_item",
        (F.col("at") - F.col("item_at")).alias("diagonal"), longer.alias("mention"),
    ).agg(F.count_distinct("item_at").alias("aligned"), F.min("at").alias("first_word"))
    return lined.filter(F.col("aligned") == F.col("in_item")).select(
        "key",
        "item_id",
        "diagonal",
        "aligned",
        F.lit(1.0).alias("coverage"),
        F.lit(True).alias("consistent"),
        "first_word",
        "mention",
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """The different (item_id, text) of a benchmark, null or not, with a key ``item``."""
    key = F.xxhash64("item_id", "text", F.col("text").isNull()).alias("item")
    return benchmark.select(key, "item_id", "text").distinct()


def item_windows(benchmark: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """A row per window of each different item that has enough plain words."""
    known = _items(benchmark)
    items = canonical(known.select(F.col("item").alias("id"), "text"), windows)
    rows = items.select(
        F.col("id").alias("item"),
        F.posexplode(F.arrays_zip("windows", "slots", "plain")).alias("item_at", "w"),
    ).filter(F.col("w.plain") >= windows.plain)
    counts = rows.groupBy("item").agg(F.count("*").alias("in_item"))
    rows = rows.select(
        "item",
        "item_at",
        F.col("w.windows").alias("window"),
        F.col("w.slots").alias("item_slots"),
    )
    return rows.join(counts, "item").join(known.select("item", "item_id"), "item")


def row_key(docs: DataFrame):
    """Equal for rows of equal id and text, null or not."""
    return F.xxhash64(docs["doc_id"], docs["text"], docs["text"].isNull())


def matches(
    docs: DataFrame, benchmark: DataFrame, windows: Windows = DEFAULT
) -> DataFrame:
    """Passages found: key, item_id, diagonal, aligned windows, coverage, consistent,
    first word, and whether it is but a mention.

    The benchmark's windows are stored and broadcast if they are few; else both sides
    are shuffled. Matches are combined map-side, so a passage
    that a third of all documents have sends one row per document.
    """
    usable = keep(item_windows(benchmark, windows), "items")
    rows = docs.select(row_key(docs).alias("id"), "text")
    zipped = canonical(rows, windows).select(
        "id", F.posexplode(F.arrays_zip("windows", "slots")).alias("at", "w")
    )
    found = zipped.select(
        F.col("id").alias("key"), "at", F.col("w.windows").alias("window"),
        F.col("w.slots").alias("slots"),
    ).join(_sent(usable), "window")
    # Windows of one hash have their placeholders in the same places.
    values = F.arrays_zip(F.col("item_slots").alias("item_value"), F.col("slots").alias("value"))
    lined = found.groupBy(
        "key", "item", "item_id", "in_item", (F.col("at") - F.col("item_at")).alias("diagonal")
    ).agg(
        F.array_distinct(F.flatten(F.collect_set(values))).alias("slots"),
        # Rows of equal key have the same places.
        F.collect_set("item_at").alias("places"),
        F.min("at").alias("first_word"),
    )
    lined = lined.withColumn("aligned", F.size("places").cast("long"))
    lined = lined.withColumn("consistent", _one_value_each(F.col("slots")))
    inside = W.partitionBy("key", "item", "consistent").orderBy("diagonal")
    opens = F.col("diagonal") - F.lag("diagonal").over(inside) > windows.drift
    opened = lined.withColumn("opens", (opens | ~F.col("consistent")).cast("int"))
    line = F.struct("diagonal", "aligned", "slots", "places", "first_word", "consistent")
    bands = (
        opened.withColumn("band", F.sum(F.coalesce("opens", F.lit(0))).over(inside))
        .groupBy("key", "item", "item_id", "consistent", "in_item", "band")
        .agg(F.collect_list(line).alias("lines"))
    )
    slots = F.array_distinct(F.flatten("lines.slots"))
    places = F.array_distinct(F.flatten("lines.places"))
    whole = F.struct(
        F.array_min("lines.diagonal").alias("diagonal"),
        F.size(places).cast("long").alias("aligned"),
        slots.alias("slots"),
        places.alias("places"),
        F.array_min("lines.first_word").alias("first_word"),
        _one_value_each(slots).alias("consistent"),
    )
    # Values that differ between diagonals leave each to itself.
    several = F.when(F.size("lines") > 1, F.concat("lines", F.array(whole)))
    lines = bands.select(
        "key", "item_id", "in_item", F.explode(F.coalesce(several, F.col("lines"))).alias("line")
    )
    aligned = lines.select(
        "key",
        "item_id",
        "line.diagonal",
        "line.aligned",
        (F.col("line.aligned") / F.col("in_item")).alias("coverage"),
        "line.consistent",
        "line.first_word",
        F.lit(False).alias("mention"),
    )
    whole = _literal_matches(docs, benchmark, usable, windows)
    return aligned if whole is None else aligned.union(whole)


def _one_value_each(slots: Column) -> Column:
    """Whether equal values of the item have equal values in the text."""
    items = F.array_distinct(F.transform(slots, lambda s: s["item_value"]))
    return F.size(items) == F.size(slots)


def _shows(windows: Windows) -> Column:
    enough = (F.col("aligned") >= windows.aligned) | (F.col("coverage") >= windows.share)
    return enough & F.col("consistent") & ~F.col("mention")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, windows: Windows = DEFAULT
) -> DataFrame:
    """Passages that show an item, as in ``matches``."""
    return matches(docs, benchmark, windows).filter(_shows(windows))


def report(docs: DataFrame, benchmark: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """One row per document: whether it shows an item and how much of it; ``items`` that
    stand in it, and those among them that are but ``mentions``, which don't make it
    contaminated."""
    found = matches(docs, benchmark, windows).withColumn("shows", _shows(windows))
    shown = F.col("shows")
    per_key = found.filter("shows OR mention").groupBy("key").agg(
        F.max("shows").alias("contaminated"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.max(F.when(shown, F.col("aligned"))).alias("aligned"),
        F.max(F.when(shown, F.col("coverage"))).alias("coverage"),
        F.array_sort(F.collect_set(F.when(F.col("mention"), F.col("item_id")))).alias("mentions"),
    )
    rows = docs.select("doc_id", row_key(docs).alias("key")).join(per_key, "key", "left")
    none = F.array().cast("array<bigint>")
    return rows.select(
        "doc_id",
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("aligned", F.lit(0)).cast("long").alias("aligned"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("mentions", none).alias("mentions"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """The documents without benchmark passages."""
    bad = contaminated(docs, benchmark, windows).select("key").distinct()
    rows = docs.select(F.struct("*").alias("row"), row_key(docs).alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")
