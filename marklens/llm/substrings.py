"""Removal of repeated passages by super-k-mers.

A window is ``window`` consecutive words of a document. Its minimiser is the least
hash of the ``gram``-word runs in it, so equal windows have equal minimisers.
Consecutive windows that share one travel as one packed string, a piece, to the
bucket of that minimiser; there the windows of all pieces are sorted, and for each
sequence of words the smallest doc_id is found. Windows that also start in a
document with a smaller doc_id come back as spans, and their words are removed.

Sorting goes by hashes of the windows; windows that fall together are then compared
in full, so the result does not depend on the hashes.

A window that starts in two documents has a minimiser that both of them have. So
minimisers are looked up first, as numbers without text: each batch of documents
sends one number per minimiser, and says itself which minimisers its own documents
share. Only pieces whose minimiser another document has too then travel.

Hot minimisers, those with more than ``crowd`` pieces, are found on the way. Their
pieces are cut into single windows, of which Spark takes the smallest doc_id, first
per window and salt, then per window. So no task gets a bucket larger than ``crowd``
pieces, nor all places of a common passage.

Edge cases: a null text has no words; a document without doc_id is compared with
none and keeps everything; rows that share a doc_id do not remove from each other;
repeated rows come back as often; a very long run of windows is cut into pieces of
``longest`` windows; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.llm.storage import keep
from marklens.llm.wordhash import SPACED_CASED, Words, buffers, chunks, grams, mix, words


@dataclass(frozen=True)
class Repeats:
    """window: words that must repeat; gram: words that a minimiser is taken from;
    crowd: pieces of one minimiser that a task takes; longest: windows of a piece;
    salts: parts into which the places of a common window are dealt; held: bytes of
    pieces that are sorted at a time, beyond one minimiser's."""

    window: int = 13
    gram: int = 4
    crowd: int = 1 << 16
    longest: int = 64
    salts: int = 256
    held: int = 1 << 20


DEFAULT = Repeats()

_SIGHTINGS = "minimiser long, row long, pieces long"
_SHARED = "row long, minimiser long, hot boolean"
_OWN = "row long, minimiser long"
_PIECES = "minimiser long, piece binary, doc_id long, row long, start int"
_WINDOWS = "piece binary, doc_id long, row long, start int"
_SPANS = "doc_id long, row long, start int, n int"
_KEPT = "doc_id long, text string, n_words long, n_removed long"


def _packed(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space after each, and where each begins and ends there."""
    sizes = w.ends - w.starts
    starts = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    inside = SPACED_CASED[w.data] != 0
    out[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = w.data[inside]
    return out.tobytes(), starts, starts + sizes


def _cut(w: Words, how: Repeats) -> tuple[np.ndarray, ...]:
    """Of the pieces: first word, row, number of windows and minimiser."""
    none = np.zeros(0, np.int64)
    parts, shift = grams(w.hashes, how.gram), how.window - how.gram
    n = len(w.hashes) - how.window + 1
    if n <= 0:
        return none, none, none, none.astype(np.uint64)
    least = parts[:n].copy()
    for i in range(1, shift + 1):
        np.minimum(least, parts[i : i + n], out=least)
    rows = w.rows
    at = _starts(w, how)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    least, row = least[at], rows[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    # Long runs are cut at every so many windows of the run.
    begins = np.flatnonzero(opens)
    since = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
    begins = np.flatnonzero(since % how.longest == 0)
    # Mixed again: least hashes are small numbers, which partition badly.
    return at[begins], row[begins], np.diff(np.append(begins, len(at))), mix(least[begins])


def _worded(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, Words]]:
    data, offsets = buffers(batch.column(column))
    for low, high in chunks(offsets):
        yield low, words(data, offsets[low : high + 1], SPACED_CASED)


def _minimisers(batch: pa.RecordBatch, how: Repeats) -> tuple[np.ndarray, ...]:
    """Minimisers of a batch with the rows that have them, in order and each once; the
    number of pieces; and the place of the first row of each minimiser."""
    keys, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    numbers = batch.column("row").to_numpy()
    for low, w in _worded(batch):
        _, row, _, minimiser = _cut(w, how)
        keys.append(minimiser.view(np.int64))
        rows.append(numbers[row + low])
    key, row = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    opens = np.ones(len(key), bool)
    opens[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(opens)
    pieces = np.diff(np.append(at, len(key)))
    key, row = key[at], row[at]
    heads = np.ones(len(key), bool)
    heads[1:] = key[1:] != key[:-1]
    return key, row, pieces, np.flatnonzero(heads)


def _sightings(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Each minimiser of a batch once, with one of its rows."""
    for batch in batches:
        key, row, pieces, heads = _minimisers(batch, how)
        if len(heads):
            total = np.add.reduceat(pieces, heads)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[heads]), pa.array(row[heads]), pa.array(total)],
                ["minimiser", "row", "pieces"],
            )


def _own(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Minimisers that rows of one batch share."""
    for batch in batches:
        key, row, _, heads = _minimisers(batch, how)
        shares = np.repeat(np.diff(np.append(heads, len(key))) > 1, np.diff(np.append(heads, len(key))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[shares]), pa.array(key[shares])], ["row", "minimiser"]
        )


def _shared(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Minimisers that rows of several batches share, and hot ones; sightings come in
    the order of the minimisers, of each as many as there are batches."""
    left: pa.Table | None = None
    for batch in batches:
        if batch.num_rows:
            some = pa.Table.from_batches([batch])
            some = some if left is None else pa.concat_tables([left, some]).combine_chunks()
            key = some.column("minimiser").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            left = some.slice(whole)
            yield from _judged(some.slice(0, whole), how)
    if left is not None:
        yield from _judged(left, how)


def _judged(sightings: pa.Table, how: Repeats) -> Iterator[pa.RecordBatch]:
    key, row, pieces = (sightings.column(c).to_numpy() for c in ("minimiser", "row", "pieces"))
    if not len(key):
        return
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(heads, len(key)))
    several = np.minimum.reduceat(row, heads) != np.maximum.reduceat(row, heads)
    hot = np.add.reduceat(pieces, heads) > how.crowd
    kept = np.repeat(several | hot, sizes)
    yield pa.RecordBatch.from_arrays(
        [pa.array(row[kept]), pa.array(key[kept]), pa.array(np.repeat(hot, sizes)[kept])],
        ["row", "minimiser", "hot"],
    )


def _pieces(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Pieces of the minimisers listed with their row. Row and minimiser are looked up
    as one number, which may let a few other pieces pass but holds none back."""
    for batch in batches:
        lists = batch.column("minimisers")
        sizes = np.diff(lists.offsets.to_numpy())
        wanted = lists.flatten().to_numpy().view(np.uint64)
        listed = wanted ^ mix(np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes))
        for low, w in _worded(batch):
            at, row, n, minimiser = _cut(w, how)
            passes = np.isin(minimiser ^ mix((row + low).astype(np.uint64)), listed)
            at, row, n, minimiser = at[passes], row[passes], n[passes], minimiser[passes]
            if not len(at):
                continue
            blob, starts, ends = _packed(w)
            last = ends[at + n + how.window - 2].tolist()
            take = pa.array(row + low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(minimiser.view(np.int64)),
                    pa.array([blob[a:b] for a, b in zip(starts[at].tolist(), last, strict=True)], pa.binary()),
                    batch.column("doc_id").take(take),
                    batch.column("row").take(take),
                    pa.array((at - w.first[row]).astype(np.int32)),
                ],
                ["minimiser", "piece", "doc_id", "row", "start"],
            )


def _windows(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """The single windows of pieces."""
    for batch in batches:
        for low, w in _worded(batch, "piece"):
            blob, starts, ends = _packed(w)
            rows, at = w.rows, _starts(w, how)
            take = pa.array(rows[at] + low)
            begins = batch.column("start").take(take).to_numpy() + (at - w.first[rows[at]])
            cuts = zip(starts[at].tolist(), ends[at + how.window - 1].tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([blob[a:b] for a, b in cuts], pa.binary()),
                    batch.column("doc_id").take(take),
                    batch.column("row").take(take),
                    pa.array(begins.astype(np.int32)),
                ],
                ["piece", "doc_id", "row", "start"],
            )


def _starts(w: Words, how: Repeats) -> np.ndarray:
    """First words of all windows."""
    rows = w.rows
    return np.flatnonzero(rows[: max(len(rows) - how.window + 1, 0)] == rows[how.window - 1 :])


def _firsts(w: Words, docs: np.ndarray, how: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Windows of texts, as their first words, and the smallest doc_id of each one's
    words; ``docs`` is the smallest doc_id of each text."""
    at = _starts(w, how)
    key, doc = grams(w.hashes, how.window)[at], docs[w.rows[at]]
    order = np.lexsort((doc, key))
    ranked = key[order]
    opens = np.ones(len(at), bool)
    opens[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(opens) - 1
    begins = np.flatnonzero(opens)
    heads = order[begins][group]
    first = np.empty(len(at), np.int64)
    first[order] = doc[heads]
    # Equal hashes are compared in full, each window with the first of its group.
    blob, starts, ends = _packed(w)
    start, end = starts[at].tolist(), ends[at + how.window - 1].tolist()
    unlike = set()
    several = heads != order
    for own, head, number in zip(
        order[several].tolist(), heads[several].tolist(), group[several].tolist(), strict=True
    ):
        if blob[start[own] : end[own]] != blob[start[head] : end[head]]:
            unlike.add(number)
    for number in unlike:
        stop = begins[number + 1] if number + 1 < len(begins) else len(at)
        least: dict[bytes, int] = {}
        for own in order[begins[number] : stop].tolist():
            first[own] = least.setdefault(blob[start[own] : end[own]], doc[own])
    return at, first


def _sorted_out(pieces: pa.Table, how: Repeats) -> Iterator[pa.RecordBatch]:
    """Spans of whole buckets; equal pieces are looked at once."""
    pieces = pieces.combine_chunks()
    coded = _one(pieces.column("piece")).dictionary_encode()
    docs, start = pieces.column("doc_id").to_numpy(), pieces.column("start").to_numpy()
    text = coded.indices.to_numpy()
    least = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, text, docs)
    data, offsets = buffers(coded.dictionary)
    w = words(data, offsets, SPACED_CASED)
    at, first = _firsts(w, least, how)
    # Each piece's windows: those of its text, one after another.
    low = np.searchsorted(at, w.first[:-1])
    sizes = np.searchsorted(at, w.first[1:]) - low
    own = sizes[text]
    piece = np.repeat(np.arange(len(text)), own)
    inside = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    repeated = docs[piece] > first[low[text][piece] + inside]
    piece, inside = piece[repeated], inside[repeated]
    if not len(piece):
        return
    opens = np.ones(len(piece), bool)
    opens[1:] = (piece[1:] != piece[:-1]) | (inside[1:] != inside[:-1] + 1)
    begins = np.flatnonzero(opens)
    n = np.diff(np.append(begins, len(piece)))
    piece, inside = piece[begins], inside[begins]
    take = pa.array(piece)
    yield pa.RecordBatch.from_arrays(
        [
            _one(pieces.column("doc_id")).take(take),
            _one(pieces.column("row")).take(take),
            pa.array((start[piece] + inside).astype(np.int32)),
            pa.array(n.astype(np.int32)),
        ],
        ["doc_id", "row", "start", "n"],
    )


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _buckets(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Sort the windows of whole buckets, some at a time; rows come in their order."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("piece").nbytes
        if size < how.held:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("minimiser").to_numpy()
        # All but the last bucket, which may go on in the next batch.
        whole = int(np.searchsorted(key, key[-1]))
        if whole:
            yield from _in_parts(table.slice(0, whole), key[:whole], how)
        held, size = table.slice(whole).combine_chunks().to_batches(), 0
    if held:
        table = pa.Table.from_batches(held)
        yield from _in_parts(table, table.column("minimiser").to_numpy(), how)


def _in_parts(table: pa.Table, key: np.ndarray, how: Repeats) -> Iterator[pa.RecordBatch]:
    """Whole buckets of about the held size together."""
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    sizes = np.cumsum(_sizes(table))
    low = 0
    while low < len(key):
        goal = (sizes[low - 1] if low else 0) + how.held
        fits = ends[(ends > low) & (sizes[ends - 1] <= goal)]
        high = int(fits[-1]) if len(fits) else int(ends[np.searchsorted(ends, low, side="right")])
        yield from _sorted_out(table.slice(low, high - low), how)
        low = high


def _sizes(table: pa.Table) -> np.ndarray:
    offsets = [buffers(chunk)[1] for chunk in table.column("piece").chunks]
    return np.concatenate([np.diff(o) for o in offsets])


def rows_of(docs: DataFrame) -> DataFrame:
    """Id and text, with a number that tells the texts of one id apart."""
    return docs.select(
        F.col("doc_id"), "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row")
    )


def shared_minimisers(rows: DataFrame, how: Repeats = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Per row the minimisers that other rows have too; and the hot ones of all."""
    known = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("row", "text")
    seen = known.mapInArrow(partial(_sightings, how=how), _SIGHTINGS)
    dealt = seen.repartition("minimiser").sortWithinPartitions("minimiser")
    shared = keep(dealt.mapInArrow(partial(_shared, how=how), _SHARED), "repeats-shared")
    own = known.mapInArrow(partial(_own, how=how), _OWN)
    listed = shared.select("row", "minimiser").unionByName(own).groupBy("row").agg(
        F.collect_set("minimiser").alias("minimisers")
    )
    return listed, shared.filter("hot").select("minimiser").distinct()


def _cold_and_hot(rows: DataFrame, how: Repeats) -> tuple[DataFrame, DataFrame]:
    listed, hot = shared_minimisers(rows, how)
    needed = rows.join(listed, "row").select("doc_id", "text", "row", "minimisers")
    pieces = needed.mapInArrow(partial(_pieces, how=how), _PIECES)
    return pieces.join(hot, "minimiser", "left_anti"), pieces.join(hot, "minimiser", "left_semi")


def removed_spans(docs: DataFrame, how: Repeats = DEFAULT) -> DataFrame:
    """Runs of windows that also start in a document with a smaller doc_id: doc_id, row
    as in ``rows_of``, the first window's first word and the number of windows."""
    cold, hot = _cold_and_hot(rows_of(docs), how)
    dealt = cold.repartition("minimiser").sortWithinPartitions("minimiser")
    ordinary = dealt.mapInArrow(partial(_buckets, how=how), _SPANS)

    single = hot.drop("minimiser").mapInArrow(partial(_windows, how=how), _WINDOWS)
    salted = single.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(how.salts)).cast("int"))
    per_salt = salted.groupBy("piece", "salt").agg(F.min("doc_id").alias("least"))
    first = per_salt.groupBy("piece").agg(F.min("least").alias("first"))
    # The condition always holds; naming the column lets both uses share one aggregate.
    known = per_salt.join(first, "piece").filter("least >= first").drop("least")
    common = salted.join(known, ["piece", "salt"]).filter("doc_id > first")
    return ordinary.unionByName(
        common.select("doc_id", "row", "start", F.lit(1).cast("int").alias("n"))
    )


def _kept(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, total, gone = [], [], []
        spans = batch.column("spans")
        for low, w in _worded(batch):
            blob, starts, ends = _packed(w)
            for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
                text, removed = blob[starts[a] : ends[b - 1]] if b > a else b"", 0
                found = spans[low + i]
                if found.is_valid:
                    marks = np.zeros(b - a + 1, np.int64)
                    at = found.values.flatten()
                    start, n = (x.to_numpy() for x in at[1:])
                    np.add.at(marks, start, 1)
                    np.add.at(marks, start + n + how.window - 1, -1)
                    stays = np.cumsum(marks[:-1]) == 0
                    removed = int((~stays).sum())
                    whole = np.frombuffer(blob, np.uint8)[starts[a] : ends[b - 1] + 1]
                    text = whole[np.repeat(stays, ends[a:b] - starts[a:b] + 1)].tobytes()[:-1]
                texts.append(text)
                total.append(b - a)
                gone.append(removed)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(total, pa.int64()),
                pa.array(gone, pa.int64()),
            ],
            ["doc_id", "text", "n_words", "n_removed"],
        )


def remove_repeats(docs: DataFrame, how: Repeats = DEFAULT) -> DataFrame:
    """Every document with the words that stay, one space between them, and how many
    words it had and lost. The first document of a passage, by doc_id, keeps it."""
    found = removed_spans(docs, how).groupBy("row").agg(
        F.collect_set(F.struct("doc_id", "start", "n")).alias("found")
    )
    # Both joins with the texts go by the row number alone and share one shuffle; rows
    # without id have a number of their own text, so they spread.
    joined = rows_of(docs).join(found, "row", "left")
    own = F.filter("found", lambda span: span["doc_id"].eqNullSafe(F.col("doc_id")))
    needed = joined.select("doc_id", "text", own.alias("spans"))
    return needed.mapInArrow(partial(_kept, how=how), _KEPT)
