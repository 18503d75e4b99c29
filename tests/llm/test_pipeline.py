import re

import corpus_pipeline
from marklens.llm import bpe
from marklens.llm.storage import keep, table
from test_neardup import shingles


def test_every_stage(spark, sf):
    """Each stage against brute force on what the one before it kept."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near-dedup", "decontamination", "secrets", "bpe"]
    docs = table(spark, sf, "documents")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(keep(stage(spark, kept[-1], sf), f"test-{name}"))
    assert all(frame.columns == columns for frame in kept[:-1])
    rows = [{r["doc_id"]: r for r in frame.collect()} for frame in kept]
    start, good, single, clean, hidden, encoded = rows

    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    wrong = [d for d, q in labels.items() if d in start and (d in good) != (q == 1)]
    assert len(wrong) <= 0.03 * len(labels)

    sets = {d: shingles(r["text"]) for d, r in good.items()}
    alike = lambda a, b: 100 * len(a & b) >= 85 * len(a | b) and a & b
    ids = sorted(sets)
    for i, a in enumerate(ids):
        earlier = any(alike(sets[a], sets[b]) for b in ids[:i])
        assert earlier or a in single
    assert not any(alike(sets[a], sets[b]) for a in single for b in single if a < b)

    items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    for d, r in single.items():
        if any(item in r["text"] for item in items):
            assert d not in clean
    assert len(clean) >= 0.9 * len(single)

    assert set(hidden) == set(clean)
    for d, r in hidden.items():
        assert not re.search(r"(?i)token = \"[0-9a-f]{40}\"", r["text"])
        if "token" not in clean[d]["text"].lower():
            assert r == clean[d]
        assert r["n_chars"] == (clean[d]["n_chars"] if r["text"] == clean[d]["text"] else len(r["text"]))

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(bpe.load_spec(corpus_pipeline.vocabulary_path()))
    assert set(encoded) == set(hidden)
    for d, r in encoded.items():
        assert r["ids"] == tokenizer.encode(hidden[d]["text"], add_special_tokens=False).ids


def test_stages_take_odd_rows(spark, sf, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf)
        if name != "bpe":
            assert set(out.columns) == set(odd_docs.columns)
        if name in ("near-dedup",):
            # Two rows of id 1 and its copy 2 become one; 6 is a near copy of 5.
            ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
            assert ids == [1, 3, 4, 5, 7, 8]
        assert stage(spark, no_docs, sf).count() == 0
