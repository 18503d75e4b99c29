"""Repeated passages against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from marklens.llm import substrings
from marklens.llm.substrings import Repeats
from marklens.llm.wordhash import SPACED_CASED, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window=13):
    first = {}
    for doc_id, text in rows:
        found = WORD.findall(text or "")
        if doc_id is not None:
            for i in range(len(found) - window + 1):
                key = tuple(found[i : i + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        found = WORD.findall(text or "")
        stays = [True] * len(found)
        for i in range(len(found) - window + 1):
            if doc_id is not None and first[tuple(found[i : i + window])] < doc_id:
                stays[i : i + window] = [False] * window
        kept = [w for w, s in zip(found, stays, strict=True) if s]
        out.append((doc_id, " ".join(kept), len(found), len(found) - len(kept)))
    return Counter(out)


def passages(seed=7, n=120):
    """Texts of few words, so that windows repeat within and across documents."""
    pick = random.Random(seed)
    common = [[pick.choice("abcdefg") + str(pick.randrange(3)) for _ in range(40)] for _ in range(4)]
    rows = []
    for doc_id in range(n):
        parts = []
        for _ in range(pick.randrange(4)):
            parts += [f"w{pick.randrange(400)}" for _ in range(pick.randrange(30))]
            some = pick.choice(common)
            low = pick.randrange(20)
            parts += some[low : low + pick.randrange(40)]
        rows.append((pick.choice([doc_id, doc_id, 3, None]), pick.choice([" ", "\t\n", "  "]).join(parts)))
    return rows + [(200 + i, "z " * pick.randrange(200)) for i in range(6)]


@pytest.mark.parametrize(
    "how",
    [Repeats(), Repeats(crowd=0), Repeats(crowd=30, salts=3), Repeats(gram=1, longest=2, held=64), Repeats(gram=13)],
)
def test_equal_to_brute_force(spark, how):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in substrings.remove_repeats(docs, how).collect())
    assert got == expected(rows)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in substrings.remove_repeats(docs).collect()) == expected(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert Counter(tuple(r) for r in substrings.remove_repeats(odd_docs).collect()) == expected(rows)
    assert substrings.remove_repeats(no_docs).count() == 0
    clash = odd_docs.selectExpr("*", "1 AS row", "2 AS start", "3 AS n", "4 AS spans", "5 AS piece", "6 AS minimiser", "7 AS id")
    assert substrings.remove_repeats(clash).count() == len(rows)


def test_windows_of_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "grams", lambda hashes, k: np.zeros(max(len(hashes) - k + 1, 0), np.uint64))
    texts = [b"a b c d", b"a b c e", b"a b c d", b"a b c e"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    w = words(data, np.arange(5, dtype=np.int64) * 7, SPACED_CASED)
    at, first = substrings._firsts(w, np.array([5, 2, 7, 1]), Repeats(window=4))
    assert at.tolist() == [0, 4, 8, 12] and first.tolist() == [5, 1, 5, 1]


def test_hot_minimisers_leave_the_buckets(spark):
    """No bucket of the ordinary way has more pieces than the bound."""
    rows = [(i, "one two three four five six seven eight nine ten eleven twelve thirteen " * 2 + f"x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cold, hot = substrings._cold_and_hot(substrings.rows_of(docs), Repeats(crowd=50))
    assert max((r["count"] for r in cold.groupBy("minimiser").count().collect()), default=0) <= 50
    assert hot.count() > 300


def test_only_shared_minimisers_travel(spark):
    """Texts that share one passage send the pieces around it, others none."""
    own = [(i, " ".join(f"w{i}x{j}" for j in range(400))) for i in range(40)]
    passage = " ".join(f"p{j}" for j in range(30))
    rows = own + [(50, f"{own[0][1]} {passage}"), (51, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cold, hot = substrings._cold_and_hot(substrings.rows_of(docs), Repeats())
    assert {r["doc_id"] for r in cold.select("doc_id").collect()} == {0, 50, 51}
    assert hot.count() == 0
