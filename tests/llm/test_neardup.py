import random
import re

import pytest

from marklens.llm import neardup
from marklens.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(rows):
    """Component and set size by comparing all pairs."""
    sets = {doc: shingles(text) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {doc: (len(sets[doc]), root(doc)) for doc in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.fixture(scope="module")
def families():
    """Families of near copies whose members are linked to some others only."""
    dice = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, doc = [], 0
    for _ in range(12):
        text = dice.choices(vocabulary, k=dice.choice([8, 40, 150, 400]))
        for _ in range(dice.choice([1, 2, 30])):
            for _ in range(dice.choice([0, 1, 2, 3])):
                text = list(text)
                text[dice.randrange(len(text))] = dice.choice(vocabulary)
            rows.append((doc, " ".join(text)))
            doc += 1
    dice.shuffle(rows)
    return rows


def test_against_all_pairs(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(neardup.near_duplicates(docs)) == brute(families)


def test_widening_finds_what_a_small_reach_misses(spark, families):
    forest = neardup.Forest(reach=1, widening=4)
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(neardup.near_duplicates(docs, forest)) == brute(families)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(neardup.near_duplicates(docs)) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    assert by_id[6]["component_id"] == 5
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == 0
    assert by_id[3]["kept"] and by_id[4]["kept"]
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_one_id_on_different_texts_ties_them(spark):
    texts = ["a b c d e f g", "h i j k l m n"]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {1}


def test_components(spark):
    dice = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(dice.randrange(1000, 1200), dice.randrange(1000, 1200)) for _ in range(90)]
    links = chain + star + loose
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["label"] for r in components(frame).collect()}
    assert got == {x: root(x) for x in got}
    # Going on from earlier labels joins whole components.
    more = spark.createDataFrame([(150, 530)], "a long, b long")
    further = {r["id"]: r["label"] for r in components(more, components(frame)).collect()}
    assert {further[x] for x in (100, 160, 500, 559)} == {100}


def crowd(pairs, others):
    """Pairs of likeness 0.87 among texts that are all alike by 0.82."""
    common = " ".join(f"c{i}" for i in range(404))
    texts = []
    for pair in range(pairs):
        shared = " ".join(f"s{pair}-{i}" for i in range(14))
        texts += [f"{common} {shared} " + " ".join(f"p{pair}-{side}-{i}" for i in range(30)) for side in "ab"]
    texts += [f"{common} " + " ".join(f"o{n}-{i}" for i in range(44)) for n in range(others)]
    # The texts of a pair get ids far apart.
    return [(1 + (at * 101) % 997, text) for at, text in enumerate(texts)]


def test_dense_region_without_links_in_reach(spark):
    rows = crowd(6, 240)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sum(doc != component for doc, (_, component) in want.items()) == 6
    # One value a tree: the region is nearly all texts, in the order of their ids.
    forest = neardup.Forest(trees=2, depth=1, least=1, first_trees=1, reach=1, widening=1)
    assert found(neardup.near_duplicates(docs, forest)) == want


def test_partition_border_marks_what_it_cuts(spark):
    rows = [(i, 1, 10, 10, 0, bytes(24)) for i in range(1, 9)] + [(9, 1, 10, 10, 1, bytes(24))]
    frame = spark.createDataFrame(
        rows, "component long, size long, n_min long, n_max long, tree int, path binary"
    )
    old = type(frame).repartitionByRange
    try:
        type(frame).repartitionByRange = lambda self, *c: old(self, 3, *c)
        pairs = neardup.neighbours(frame, 8, neardup.DEFAULT).localCheckpoint()
    finally:
        type(frame).repartitionByRange = old
    seen = {(r["a"], r["b"]) for r in pairs.filter("candidate").collect()}
    missed = {(a, b) for a in range(1, 9) for b in range(a + 1, 9)} - seen
    marked = {r["a"] for r in neardup.crowded(pairs).collect()}
    assert missed and {x for pair in missed for x in pair} <= marked and 9 not in marked


def test_one_tree_tells_what_all_trees_tell(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string").dropDuplicates(["text"])
    sets = neardup.keep(neardup.signatures(docs).filter("digest IS NOT NULL"), "sets")
    labels = spark.createDataFrame([], "id long, label long")
    rows = neardup.shared_regions(sets)
    got = [
        {(r["a"], r["b"]) for r in neardup.region_pairs(rows, labels, 4096, sets=sets, first_tree=x).filter("candidate").collect()}
        for x in (False, True)
    ]
    assert got[0] == got[1] and len(got[0]) > 100
