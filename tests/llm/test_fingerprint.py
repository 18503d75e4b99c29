import hashlib
import math
import random
from collections import Counter

import numpy as np

from marklens.llm import fingerprint as fp


def test_entropies_like_brute_force():
    dice = random.Random(1)
    data = np.frombuffer(bytes(dice.choices(b"aaab cdexyz", k=400)), np.uint8)
    got = fp._entropy_bins(data, 32)
    assert len(got) == 400 - 31
    for i, value in enumerate(got):
        counts = Counter(data[i : i + 32].tolist()).values()
        entropy = -sum(c / 32 * math.log2(c / 32) for c in counts)
        assert abs(value - entropy / 5 * (fp.BINS - 1)) <= 1.01


def test_a_text_has_one_fingerprint_whatever_stands_beside_it():
    ranks = np.arange(fp.BINS)
    dice = random.Random(2)
    parts = [bytes(dice.choices(b"abcdefghij klmnop", k=n)) for n in (5, 100, 127, 128, 900, 5000)]
    together = fp.chains(parts, ranks)
    for part, chain in zip(parts, together, strict=True):
        (alone,) = fp.chains([b"other text " * 30, part], ranks)[1:]
        assert np.array_equal(chain, alone)
        assert np.array_equal(fp.from_text(fp.as_text(chain)), chain)
        assert fp.likeness(chain, alone) == 1.0


def brute_edits(rows):
    order = sorted(rows, key=lambda r: -r[0])
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        yield doc, (len(text), hashlib.sha256(edited.encode()).hexdigest())


def test_edited_texts_and_likeness(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = fp.edited_likeness(docs, fp.rarity(docs)).collect()
    want = dict(brute_edits([tuple(r) for r in docs.collect()]))
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == want
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.97
    single = docs.limit(1)
    (row,) = fp.edited_likeness(single, fp.rarity(single)).collect()
    assert row["near_next"] == 1.0


def test_odd_rows(spark, odd_docs, no_docs):
    ranks = fp.rarity(odd_docs)
    rows = fp.edited_likeness(odd_docs, ranks).collect()
    assert len(rows) == odd_docs.count()
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[1] == prints[2] and prints[3] == prints[4] == ""
    assert fp.fingerprints(odd_docs, ranks).count() == odd_docs.count()
    assert fp.edited_likeness(no_docs, fp.rarity(no_docs)).count() == 0
