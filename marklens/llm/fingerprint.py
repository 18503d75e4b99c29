"""Fingerprints of improbable features.

Every byte window of a text has an entropy. How rare its entropy is over all
windows of the corpus ranks it, improbable first. Windows that are the rarest
among their neighbours often enough become features; they are inserted into a
chain of Bloom filters of fixed size, a new one when the last is full. Two
fingerprints are compared by the bits their filters share, between what chance
gives and what is possible.

Edge cases: a null text reads as empty; an empty text has an empty fingerprint; a
text of few bytes has all its small windows; equal texts have equal fingerprints;
rows of equal doc_id are ordered by text; a row without doc_id comes last.
"""

from __future__ import annotations

from base64 import b64decode, b64encode
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.llm.wordhash import CHUNK_BYTES, buffers, chunks, mix

BINS = 1024
_SCALE = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Digest:
    """window: bytes of a feature; run: neighbours it competes with; wins: runs in
    which it must be the rarest; short: texts of fewer bytes give all windows of
    ``small`` bytes instead; bits: of a filter; full: features in a filter;
    probes: bits per feature; chance: share of the way from chance to the most
    possible overlap that still counts as none."""

    window: int = 32
    run: int = 32
    wins: int = 16
    short: int = 128
    small: int = 8
    bits: int = 2048
    full: int = 160
    probes: int = 5
    chance: float = 0.3


DEFAULT = Digest()


def _entropy_bins(data: np.ndarray, window: int) -> np.ndarray:
    """Binned entropy of each window; whole numbers, so equal bytes give equal bins."""
    n = len(data) - window + 1
    # How often a byte occurs in the window before it, and in the one it opens.
    before, after = np.zeros(len(data), np.uint8), np.ones(len(data), np.uint8)
    block = 1 << 16
    for low in range(0, len(data), block):
        high = min(low + block, len(data))
        here = data[low:high]
        for step in range(1, window):
            stop = min(high, len(data) - step)
            if stop <= low:
                break
            same = (here[: stop - low] == data[low + step : stop + step]).view(np.uint8)
            after[low:stop] += same
            before[low + step : stop + step] += same
    counts = np.arange(window + 2, dtype=np.float64)
    weight = np.zeros(window + 2, np.int64)
    weight[1:] = np.rint(counts[1:] * np.log2(counts[1:]) * _SCALE)
    gain, loss = np.diff(weight), np.diff(weight, prepend=0)
    total = np.empty(n, np.int64)
    total[0] = weight[np.bincount(data[:window], minlength=256)].sum()
    total[1:] = gain[before[window:]] - loss[after[: n - 1]]
    np.cumsum(total, out=total)
    most = int(weight[window])
    return ((most - total) * (BINS - 1) // most).astype(np.int64)


def _valid(offsets: np.ndarray, n: int, length: int) -> np.ndarray:
    """Whether ``length`` values from a place stay in one row."""
    left = np.zeros(n, np.int64)
    at = offsets - offsets[0]
    sizes = np.diff(at)
    left = np.repeat(at[1:], sizes) - np.arange(at[-1])
    return left[:n] >= length


def _count(batches: Iterator[pa.RecordBatch], digest: Digest) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BINS, np.int64)
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for low, high in chunks(offsets):
            at = offsets[low : high + 1]
            part = data[at[0] : at[-1]]
            if len(part) >= digest.window:
                bins = _entropy_bins(part, digest.window)
                inside = _valid(at, len(bins), digest.window)
                total += np.bincount(bins[inside], minlength=BINS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BINS), pa.int32()), pa.array(total)], names=["bin", "windows"]
    )


def rarity(docs: DataFrame, digest: Digest = DEFAULT) -> list[int]:
    """Rank of each entropy bin, rarest first, from all windows of all texts.

    The driver gets one row per bin. Keep the list to compare with later corpora.
    """
    counted = docs.select("text").mapInArrow(partial(_count, digest=digest), "bin int, windows long")
    rows = counted.groupBy("bin").agg(F.sum("windows").alias("windows")).collect()
    windows = {row["bin"]: row["windows"] for row in rows}
    order = sorted(range(BINS), key=lambda b: (windows.get(b, 0), b))
    ranks = [0] * BINS
    for rank, b in enumerate(order):
        ranks[b] = rank
    return ranks


def _rarest(keys: np.ndarray, run: int) -> np.ndarray:
    """Minimum of every ``run`` consecutive keys."""
    n = len(keys)
    padded = np.full(-(-n // run) * run, ~np.uint64(0))
    padded[:n] = keys
    blocks = padded.reshape(-1, run)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - run + 1], ahead[run - 1 : n])


def _window_hashes(data: np.ndarray, window: int) -> np.ndarray:
    """Hash of each window, by doubling the length hashed."""
    values, length = mix(data.astype(np.uint64) + np.uint64(1)), 1
    while length < window:
        step = min(length, window - length)
        n = len(values) - step
        values = mix(values[:n] * _BASE + values[step : step + n])
        length += step
    return values


def features(parts: list[bytes], ranks: np.ndarray, digest: Digest) -> list[np.ndarray]:
    """Hashes of the chosen windows of each text, in order, each once."""
    sizes = np.array([len(p) for p in parts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(parts), np.uint8)
    wide = digest.window + digest.run - 1
    found: list[np.ndarray] = []
    chosen = hashes = np.zeros(0, np.int64)
    if len(data) >= wide:
        keys = ranks[_entropy_bins(data, digest.window)].astype(np.uint64)
        keys = (keys << np.uint64(48)) | np.arange(len(keys), dtype=np.uint64)
        best = _rarest(keys, digest.run)
        best = best[_valid(offsets, len(best), wide)] & np.uint64((1 << 48) - 1)
        won = np.bincount(best.astype(np.int64), minlength=len(keys))
        chosen = np.flatnonzero(won >= digest.wins)
        hashes = _window_hashes(data, digest.window)[chosen]
    bounds = np.searchsorted(chosen, offsets)
    for i, part in enumerate(parts):
        own = hashes[bounds[i] : bounds[i + 1]].astype(np.uint64)
        if part and (not len(own) or len(part) < digest.short):
            own = _few(np.frombuffer(part, np.uint8), ranks, digest)
        _, first = np.unique(own, return_index=True)
        found.append(own[np.sort(first)])
    return found


def _few(data: np.ndarray, ranks: np.ndarray, digest: Digest) -> np.ndarray:
    """Features of a text with too few windows to compete, or with even ones only:
    all its small windows, or its rarest large one."""
    if len(data) >= digest.short:
        best = int(np.argmin(ranks[_entropy_bins(data, digest.window)]))
        return _window_hashes(data[best : best + digest.window], digest.window)
    return _window_hashes(data, min(digest.small, len(data)))


def filters(found: np.ndarray, digest: Digest) -> np.ndarray:
    """Chained Bloom filters, a row of bytes for each."""
    n = -(-len(found) // digest.full)
    bits = np.zeros((n, digest.bits), np.uint8)
    row = np.arange(len(found)) // digest.full
    for probe in range(digest.probes):
        bits[row, (found >> np.uint64(12 * probe)).astype(np.int64) % digest.bits] = 1
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray, digest: Digest = DEFAULT) -> float:
    """Mean over the shorter chain of each filter's best normalised overlap, 0 to 1."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(b) < len(a):
        a, b = b, a
    size_a, size_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    best = []
    for row, size in zip(a, size_a, strict=True):
        common = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(size, size_b)
        random = size * size_b / digest.bits
        floor = random + digest.chance * (most - random)
        best.append(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max())
    return float(np.mean(best))


def as_text(chain: np.ndarray) -> str:
    return b64encode(chain.tobytes()).decode()


def from_text(fingerprint: str, digest: Digest = DEFAULT) -> np.ndarray:
    return np.frombuffer(b64decode(fingerprint), np.uint8).reshape(-1, digest.bits // 8)


def chains(parts: list[bytes], ranks: np.ndarray, digest: Digest = DEFAULT) -> list[np.ndarray]:
    return [filters(found, digest) for found in features(parts, ranks, digest)]


def _print(
    batches: Iterator[pa.RecordBatch], ranks: list[int], digest: Digest
) -> Iterator[pa.RecordBatch]:
    ranks = np.array(ranks)
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        raw = data.tobytes() if not len(data) else data
        for low, high in chunks(offsets):
            parts = [
                bytes(raw[a:b]) for a, b in zip(offsets[low:high], offsets[low + 1 : high + 1], strict=True)
            ]
            prints = [as_text(x) for x in chains(parts, ranks, digest)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, high - low), pa.array(prints, pa.string())],
                names=["doc_id", "fingerprint"],
            )


def fingerprints(docs: DataFrame, ranks: list[int], digest: Digest = DEFAULT) -> DataFrame:
    """Fingerprint of every text, as (doc_id, fingerprint); no shuffle."""
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(
        partial(_print, ranks=ranks, digest=digest), "doc_id long, fingerprint string"
    )


# Comparing each document with an edited version of itself and with its neighbour


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows in buckets of consecutive ids, in descending order, such that every
    row but a bucket's last is followed by the next document.

    Bucket borders are ids of the table, found by one aggregate; the greatest id
    of a bucket is sent to the bucket above as well, as its last row, and that of
    the top bucket to the lowest. Texts are shuffled once.
    """
    spark = docs.sparkSession
    least = -(1 << 63)
    key = F.coalesce("doc_id", F.lit(least))
    buckets = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 4096)
    shares = [i / buckets for i in range(1, buckets)]
    cuts, top = docs.agg(F.percentile_approx(key, shares, 10 * buckets), F.max(key)).first()
    cuts = sorted({*(cuts or []), top if top is not None else least})
    borders = F.array(*[F.lit(c) for c in cuts])
    bucket = F.size(F.filter(borders, lambda c: c < F.col("order")))
    home = F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest"))
    above = F.struct(((F.col("own") + 1) % len(cuts)).alias("bucket"), F.lit(1).alias("guest"))
    places: Column = F.when(
        F.array_contains(borders, F.col("order")), F.array(home, above)
    ).otherwise(F.array(home))
    rows = docs.select("doc_id", "text", key.alias("order")).withColumn("own", bucket)
    rows = rows.select("doc_id", "order", "text", F.explode(places).alias("at"))
    rows = rows.select("doc_id", "order", "text", "at.bucket", "at.guest")
    # As many partitions as the session shuffles into, so that a bucket is small.
    return rows.repartition(max(buckets // 4, 1), "bucket").sortWithinPartitions(
        "bucket", "guest", F.desc("order"), "text"
    )


def _edit(
    batches: Iterator[pa.RecordBatch], ranks: list[int], digest: Digest
) -> Iterator[pa.RecordBatch]:
    ranks = np.array(ranks)
    waiting, size = [], 0  # rows whose successor is known: id, text, successor
    last = None

    def flush() -> pa.RecordBatch:
        nonlocal waiting, size
        ids, own, following = zip(*waiting, strict=True)
        edited = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(own, following, strict=True)]
        # Successors are the next rows' own texts, save at the end of a run.
        texts = {t: i for i, t in enumerate(dict.fromkeys([*own, *following, *edited]))}
        parts = [t.encode() for t in texts]
        found = chains(parts, ranks, digest)
        mine, next_one, changed = (
            [found[texts[t]] for t in side] for side in (own, following, edited)
        )
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in own], pa.int64()),
                pa.array([sha256(parts[texts[t]]).hexdigest() for t in edited]),
                pa.array([as_text(x) for x in mine], pa.string()),
                pa.array([as_text(x) for x in changed], pa.string()),
                pa.array([likeness(a, b, digest) for a, b in zip(mine, changed, strict=True)], pa.float64()),
                pa.array([likeness(a, b, digest) for a, b in zip(mine, next_one, strict=True)], pa.float64()),
            ],
            names=[
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                "near_edited", "near_next",
            ],
        )
        waiting, size = [], 0
        return out

    for batch in batches:
        columns = (batch.column(c) for c in ("doc_id", "bucket", "guest", "text"))
        for doc, bucket, guest, text in zip(*columns, strict=True):
            row = (doc.as_py(), bucket.as_py(), guest.as_py(), text.as_py() or "")
            if last is not None and last[1] == row[1] and not last[2]:
                waiting.append((last[0], last[3], row[3]))
                size += len(last[3])
                if size >= CHUNK_BYTES // 2:
                    yield flush()
            last = row
    if waiting:
        yield flush()


def edited_likeness(docs: DataFrame, ranks: list[int], digest: Digest = DEFAULT) -> DataFrame:
    """Each document against its edited version and against the next document.

    Edited: the last third of the code points replaced by the first as many of
    the next document in descending doc_id; after the last comes the first.
    """
    return _with_next(docs).mapInArrow(
        partial(_edit, ranks=ranks, digest=digest),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
