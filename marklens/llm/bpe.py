"""BPE encoding and decoding by a table of distinct words.

Words are what stands between blanks and line ends; the tokenizers served here drop
white space and never join text across it, so a text's ids are its words' ids in
turn.

1. Texts are split in blocks of rows. Each block lists its distinct words, dealt
   into parts by a hash of the word and sorted.
2. The lists of all blocks meet by part. Each distinct word is encoded once, and its
   ids go back to the blocks that asked, in the order of their lists.
3. A block, which comes to the same task, puts the ids at the places of its words.

Decoding joins each id with its piece; the table of pieces has as many rows as the
vocabulary and is there in every task, so its side of the join is looked up by id.

At scale: a word is sent once per block, however frequent, and lists are packed, so
Spark handles a row per block and part. Texts are shuffled once, packed. A part is
held by one task, so their number has to grow with the number of distinct words, as
that of the shuffle partitions does. Texts are split twice, in step 1 and for step 3;
a block has the number of its partition of the texts and its place in that, with a
digest of its rows, so blocks that do not meet again (rows that come in another order
when computed again) are noticed. Their words are then encoded in step 3. The number
is a column, as texts and answers are tasks of one stage and numbered through there.

Edge cases: a null text reads as empty; an empty text has no ids and decodes to
an empty text; repeated rows stay; a word of any length is encoded whole; a text
longer than a block is one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b, sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.llm.wordhash import buffers, chunks, mix

#: Bytes of text in a block, beyond a single longer one.
BLOCK_BYTES = 8 << 20
#: Distinct words that are encoded at a time.
WORDS = 20_000

_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, 0x0A]] = False


def load_spec(path: str) -> str:
    """The tokenizer's description, sent to the workers as text."""
    return Path(path).read_text(encoding="utf-8")


def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _ids(tokenizer, words: list[str]) -> list[list[int]]:
    return [x.ids for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def _encoded_words(tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of every word, and all ids."""
    found = []
    for low in range(0, len(words), WORDS):
        found += _ids(tokenizer, words.slice(low, WORDS).cast(pa.string()).to_pylist())
    sizes = np.array([len(ids) for ids in found], np.int64)
    return sizes, np.array([number for ids in found for number in ids], np.int32)


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of consecutive rows, and the number of words before each row's end."""
    at = offsets - offsets[0]
    data = data[offsets[0] : offsets[-1]]
    n = len(data)
    inside = _INSIDE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < n]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    # Lengths by counting the bytes that belong to words.
    counted = np.cumsum(inside)
    bounds = counted[starts] - 1 if n else np.zeros(0, np.int64)
    ends = np.append(bounds, counted[-1] if n else 0).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
    )
    return words, np.searchsorted(starts, at[1:])


def _name(data: np.ndarray, offsets: np.ndarray, task: int, number: int) -> bytes:
    """Of a block: its scan task, its place in that, and a digest of its texts."""
    seen = blake2b(data[offsets[0] : offsets[-1]], digest_size=8)
    seen.update((offsets - offsets[0]).tobytes())
    return f"{task}-{number}-{seen.hexdigest()}".encode()


_WEIGHTS = mix(np.arange(1, 257, dtype=np.uint64))


def _dealt(words: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the words by part, sorted inside, and where each part begins."""
    order = pc.sort_indices(words).to_numpy().astype(np.int64)
    data, offsets = buffers(words)
    data = data[offsets[0] : offsets[-1]]
    starts = (offsets - offsets[0])[:-1]
    part = mix(np.add.reduceat(_WEIGHTS[data], starts)) % np.uint64(parts) if len(words) else starts
    part = part.astype(np.int64)
    order = order[np.argsort(part[order], kind="stable")]
    return order, np.searchsorted(part[order], np.arange(parts + 1))


class _Block:
    """Rows with their distinct words, the word's number at every place, the words
    before the end of each row, and the order in which words are asked for."""

    def __init__(self, rows: pa.RecordBatch, parts: int):
        words, self.ends = _split(*buffers(rows.column("text")))
        coded = words.dictionary_encode()
        self.words, self.places = coded.dictionary, coded.indices.to_numpy()
        self.order, self.cuts = _dealt(self.words, parts)


def _blocks(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[pa.RecordBatch, bytes]]:
    number = 0
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        rows = batch.select(["doc_id", "text"])
        for low, high in chunks(offsets, size):
            name = _name(data, offsets[low : high + 1], batch.column("task")[low].as_py(), number)
            yield rows.slice(low, high - low), name
            number += 1


_ASKED = "part int, block binary, words binary, size int"
_ROWS = "block binary, part int, found binary, size int, texts binary"


def _squeezed(*arrays: np.ndarray) -> tuple[bytes, int]:
    raw = b"".join(a.tobytes() for a in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True), len(raw)


def _opened(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _ask(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of every block, packed per part: their number, their
    lengths, the words."""
    for rows, name in _blocks(batches, size):
        block = _Block(rows, parts)
        data, offsets = buffers(block.words.take(pa.array(block.order)))
        asked = np.flatnonzero(np.diff(block.cuts))
        packed = []
        for part in asked.tolist():
            at = offsets[block.cuts[part] : block.cuts[part + 1] + 1]
            lengths = np.append(len(at) - 1, np.diff(at)).astype("<u4")
            packed.append(_squeezed(lengths, data[at[0] : at[-1]]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(asked, pa.int32()),
                pa.array([name] * len(asked), pa.binary()),
                pa.array([x for x, _ in packed], pa.binary()),
                pa.array([n for _, n in packed], pa.int32()),
            ],
            ["part", "block", "words", "size"],
        )


def _unpacked(packed: bytes, size: int) -> pa.Array:
    raw = _opened(packed, size)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    lengths = np.frombuffer(raw, "<u4", n, 4)
    ends = np.append(0, np.cumsum(lengths, dtype=np.int64)).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(raw[4 + 4 * n :])]
    )


def _answer(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    """Ids of the words of every part, in the order of each block's list."""
    tokenizer, part, lists = _tokenizer(spec), None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "block", "words", "size")]
        for own, block, words, size in zip(*columns, strict=True):
            if own != part:
                yield from _answered(part, lists, tokenizer)
                part, lists = own, []
            lists.append((block, _unpacked(words, size)))
    yield from _answered(part, lists, tokenizer)


def _answered(part: int | None, lists: list, tokenizer) -> Iterator[pa.RecordBatch]:
    if not lists:
        return
    coded = pa.concat_arrays([words for _, words in lists]).dictionary_encode()
    sizes, ids = _encoded_words(tokenizer, coded.dictionary)
    starts, numbers = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
    low, blocks, found = 0, [], []
    for block, words in lists:
        own = numbers[low : low + len(words)]
        low += len(words)
        blocks.append(block)
        found.append(
            _squeezed(
                np.array([len(own)], "<u4"),
                sizes[own].astype("<u4"),
                ids[_spread(starts[own], sizes[own])].astype("<u4"),
            )
        )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(blocks, pa.binary()),
            pa.array([part] * len(blocks), pa.int32()),
            pa.array([x for x, _ in found], pa.binary()),
            pa.array([n for _, n in found], pa.int32()),
            pa.nulls(len(blocks), pa.binary()),
        ],
        ["block", "part", "found", "size", "texts"],
    )


def _send(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of every block, packed."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for rows, name in _blocks(batches, size):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
            out.write_batch(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name], pa.binary()),
                pa.nulls(1, pa.int32()),
                pa.nulls(1, pa.binary()),
                pa.nulls(1, pa.int32()),
                pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            ],
            ["block", "part", "found", "size", "texts"],
        )


class _Known:
    """Ids of a block's words, as far as answers have come, in the order asked."""

    def __init__(self):
        self.sizes, self.ids = [], []

    def add(self, found: bytes, size: int) -> None:
        numbers = np.frombuffer(_opened(found, size), "<u4")
        n = int(numbers[0])
        self.sizes.append(numbers[1 : n + 1])
        self.ids.append(numbers[n + 1 :])

    def all(self, block: _Block, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Size and ids of every word, in the order of their numbers."""
        none = np.zeros(0, np.uint32)
        sizes = np.concatenate([none, *self.sizes]).astype(np.int64)
        if len(sizes) != len(block.words):
            return _encoded_words(tokenizer, block.words)
        ids = np.concatenate([none, *self.ids]).astype(np.int32)
        starts, at = np.cumsum(sizes) - sizes, np.empty(len(sizes), np.int64)
        at[block.order] = np.arange(len(sizes))
        return sizes[at], ids[_spread(starts[at], sizes[at])]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _place(batches: Iterator[pa.RecordBatch], spec: str, parts: int) -> Iterator[pa.RecordBatch]:
    """Ids of every text, from the rows of its block: answers first, then texts."""
    tokenizer, name, known = _tokenizer(spec), None, _Known()
    for batch in batches:
        columns = [batch.column(c) for c in ("block", "found", "size", "texts")]
        for row in range(batch.num_rows):
            block, found, size, texts = (c[row].as_py() for c in columns)
            if block != name:
                name, known = block, _Known()
            if texts is None:
                known.add(found, size)
                continue
            for rows in pa.ipc.open_stream(texts).read_all().combine_chunks().to_batches():
                yield from _encoded(rows, known, tokenizer, parts)


def _encoded(rows: pa.RecordBatch, known: _Known, tokenizer, parts: int) -> Iterator[pa.RecordBatch]:
    block = _Block(rows, parts)
    sizes, ids = known.all(block, tokenizer)
    starts, first = np.cumsum(sizes) - sizes, 0
    # Some rows at a time, so that ids of long texts do not pile up.
    _, offsets = buffers(rows.column("text"))
    for a, b in chunks(offsets):
        last = int(block.ends[b - 1])
        words = block.places[first:last]
        per_word = sizes[words]
        flat = ids[_spread(starts[words], per_word)]
        upto = np.concatenate([[0], np.cumsum(per_word)])
        ends = upto[np.concatenate([[first], block.ends[a:b]]) - first]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").slice(a, b - a),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
            ],
            ["doc_id", "ids"],
        )
        first = last


def _parts(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(docs: DataFrame) -> DataFrame:
    """The texts with the number of their partition, which a union leaves as it is."""
    return docs.select("doc_id", "text", F.spark_partition_id().alias("task"))


def word_ids(docs: DataFrame, spec: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every distinct word encoded once, its ids packed for the blocks that have it."""
    ask = partial(_ask, size=block_bytes, parts=_parts(docs))
    asked = _numbered(docs).mapInArrow(ask, _ASKED)
    dealt = asked.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(partial(_answer, spec=spec), _ROWS)


def block_rows(docs: DataFrame, spec: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The answers to every block and its packed texts, under the same name."""
    texts = _numbered(docs).mapInArrow(partial(_send, size=block_bytes), _ROWS)
    return word_ids(docs, spec, block_bytes).unionByName(texts)


def encode(docs: DataFrame, spec: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token ids of every text, as (doc_id, ids)."""
    rows = block_rows(docs, spec, block_bytes)
    rows = rows.withColumn("late", F.col("texts").isNotNull())
    met = rows.repartition("block").sortWithinPartitions("block", "late", "part").drop("late")
    place = partial(_place, spec=spec, parts=_parts(docs))
    return met.mapInArrow(place, "doc_id long, ids array<int>")


def pieces(spec: str) -> dict[int, str]:
    """Piece of every id, a blank before it; as many as the vocabulary has."""
    described = json.loads(spec)
    rows = {number: " " + piece for piece, number in described["model"]["vocab"].items()}
    return rows | {x["id"]: " " + x["content"] for x in described["added_tokens"]}


def _spell(batches: Iterator[pa.RecordBatch], spec: str, digests: bool) -> Iterator[pa.RecordBatch]:
    known = pieces(spec)
    size = max(known, default=-1) + 1
    # An id that the vocabulary lacks has an empty piece; the last one is for them.
    table = pa.array([known.get(i, "").encode() for i in range(size)] + [b""], pa.binary())
    digits = pa.array([str(i) for i in range(size)], pa.string())
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        bounds = offsets - offsets[0]
        # Some rows at a time.
        for a, b in chunks(bounds, 1 << 18):
            ids = lists.values.slice(int(offsets[a]), int(offsets[b] - offsets[a])).to_numpy()
            place = np.where((ids >= 0) & (ids < size), ids, size)
            data, at = buffers(table.take(pa.array(place)))
            ends = at[bounds[a : b + 1] - bounds[a]]
            blob = data[: ends[-1]].tobytes() if len(data) else b""
            texts = [blob[x:y].removeprefix(b" ") for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            docs = batch.column("doc_id").slice(a, b - a)
            if not digests:
                spelled = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([docs, spelled], ["doc_id", "text"])
                continue
            cuts = pa.array(bounds[a : b + 1] - bounds[a], pa.int32())
            numbers = digits.take(pa.array(ids)) if (place < size).all() else pa.array(ids).cast(pa.string())
            listed = pc.binary_join(pa.ListArray.from_arrays(cuts, numbers), " ").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    docs,
                    pa.array(np.diff(bounds[a : b + 1])),
                    pa.array([sha256(x.encode()).hexdigest() for x in listed]),
                    pa.array([sha256(x).hexdigest() for x in texts]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def decode(encoded: DataFrame, spec: str, digests: bool = False) -> DataFrame:
    """The text of every row's ids, as (doc_id, text).

    A tokenizer without a decoder spells its pieces with a blank in between. An id
    that the vocabulary lacks has no piece and is passed over. ``digests`` gives
    n_tokens and SHA-256 of the ids and of the text instead of the text.
    """
    if json.loads(spec)["decoder"] is not None:
        raise ValueError("only tokenizers without a decoder of their own are served")
    schema = "doc_id long, text string"
    if digests:
        schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.select("doc_id", "ids").mapInArrow(partial(_spell, spec=spec, digests=digests), schema)
