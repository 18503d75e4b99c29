import hashlib

import pytest

from marklens.llm import bpe
from marklens.llm.queries import vocabulary_path

TEXTS = [
    "Hello world, it's 2024!\n\nNew  line\tand\ttab ",
    " leading blank and <|endoftext|> inside<|startoftext|>",
    "",
    None,
    "ÀÉÎ straße ΣΑΣ İstanbul  nbsp em é combining \U0001f600\U0001f468‍\U0001f469",
    "x" * 3000 + " " + "abc" * 40,
    "   \n\n  ",
    "don't we'll they've I'm he'd 's 't",
    "同じ テキスト 日本語 한국어 العربية",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary_path())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.mark.parametrize("size", [1, 200, 8 << 20])
def test_like_the_library(spark, tokenizer, size):
    """Whatever the size of a block."""
    spec = bpe.load_spec(vocabulary_path())
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    encoded = bpe.encode(docs, spec, size)
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    texts = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, spec).collect()}
    sums = {r["doc_id"]: r for r in bpe.decode(encoded, spec, digests=True).collect()}
    for doc, text in rows:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        spelled = tokenizer.decode(want, skip_special_tokens=False)
        assert ids[doc] == want
        assert texts[doc] == spelled
        assert sums[doc]["n_tokens"] == len(want)
        assert sums[doc]["decoded_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        listed = " ".join(map(str, want)).encode()
        assert sums[doc]["ids_sha256"] == hashlib.sha256(listed).hexdigest()


def test_texts_longer_than_a_batch(spark, tokenizer):
    spec = bpe.load_spec(vocabulary_path())
    rows = [(i, " ".join(f"w{j % 91}" for j in range(i * 7000))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    encoded = bpe.encode(docs, spec)
    texts = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, spec).collect()}
    for doc, text in rows:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert texts[doc] == tokenizer.decode(want, skip_special_tokens=False)


def test_odd_rows(spark, odd_docs, no_docs):
    spec = bpe.load_spec(vocabulary_path())
    rows = bpe.encode(odd_docs, spec).collect()
    assert len(rows) == odd_docs.count()
    assert bpe.decode(bpe.encode(no_docs, spec), spec).count() == 0


def test_blocks_meet_by_word(spark, tokenizer):
    """Every block is answered once per part; its ids are those of its own words."""
    spec = bpe.load_spec(vocabulary_path())
    rows = [(i, f"common word{i % 7} own{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    answers = [(r["block"], r["part"]) for r in bpe.word_ids(docs, spec).collect()]
    assert len({block for block, _ in answers}) == 6 and len(answers) == len(set(answers))
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, spec).collect()}
    assert all(ids[i] == tokenizer.encode(t, add_special_tokens=False).ids for i, t in rows)


@pytest.mark.parametrize("size", [40, 8 << 20])
def test_texts_meet_the_answers_to_their_block(spark, size):
    """Both are told the same name, though the tasks of a union have other numbers."""
    spec = bpe.load_spec(vocabulary_path())
    rows = [(i, f"common word{i % 7} own{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    met = [(r["block"], r["part"], r["texts"]) for r in bpe.block_rows(docs, spec, size).collect()]
    answered = {block for block, part, _ in met if part is not None}
    sent = [block for block, _, texts in met if texts is not None]
    assert len(sent) == len(set(sent)) >= 6 and set(sent) == answered


def test_a_block_without_all_answers_is_encoded_in_place(tokenizer):
    """As when rows come in another order when they are computed again."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["hello wide", "world hello"])], ["doc_id", "text"])
    (found,) = bpe._encoded(rows, bpe._Known(), tokenizer, 4)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("hello wide", "world hello")]
    assert found.column("ids").to_pylist() == want


def test_a_part_encodes_each_word_once(tokenizer):
    import numpy as np
    import pyarrow as pa

    asked = []

    class Counting:
        def encode_batch_fast(self, words, add_special_tokens):
            asked.extend(words)
            return tokenizer.encode_batch_fast(words, add_special_tokens=add_special_tokens)

    lists = [(b"x", pa.array([b"a", b"wide"], pa.binary())), (b"y", pa.array([b"wide", b"world"], pa.binary()))]
    (rows,) = bpe._answered(3, lists, Counting())
    assert sorted(asked) == ["a", "wide", "world"] and rows.column("block").to_pylist() == [b"x", b"y"]
    known = bpe._Known()
    known.add(rows.column("found")[1].as_py(), rows.column("size")[1].as_py())
    want = tokenizer.encode("wide world", add_special_tokens=False).ids
    assert np.concatenate(known.ids).tolist() == want
