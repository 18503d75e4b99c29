"""Manifest and proofs against a plain tree."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from marklens.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    parts = []
    for c in COLUMNS:
        value = None if row[c] is None else str(row[c])
        if c == "text" and lower and value is not None:
            value = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in value)
        parts.append("-" if value is None else f"{len(value.encode())}:{value}")
    return digest("".join(parts))


def tree(hashes):
    """The last hash, and of each node at the bottom its siblings level by level."""
    if not hashes:
        return None, []
    ways, seats = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for way, seat in zip(ways, seats, strict=True):
            low = seat // 16 * 16
            way.append(("".join(hashes[low:seat]), "".join(hashes[seat + 1 : low + 16])))
        hashes = [digest("".join(hashes[i : i + 16])) for i in range(0, len(hashes), 16)]
        seats = [s // 16 for s in seats]
    return hashes[0], ways


def expected(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row["source"]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in sources[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for top, s in zip(tops, names, strict=True):
        for row, way in zip(sources[s], trees[s][1], strict=True):
            steps = way + top
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            node = leaf(row, lower=hit)
            for left, right in steps:
                node = digest(left + node + right)
            proof = digest("".join(a + b for a, b in steps))
            out.append((row["doc_id"], leaf(row), trees[s][0], root, proof, node, node == root))
    return Counter(out)


def check(docs):
    got = Counter(tuple(r) for r in merkle.report(docs).collect())
    want = expected([r.asDict() for r in docs.select(*COLUMNS).collect()])
    assert got == want
    return got


def test_table(spark, sf):
    got = check(spark.read.parquet(f"{sf}/documents.parquet"))
    # Texts with capitals fail where they were tampered with, all others pass.
    assert 0 < sum(n for row, n in got.items() if not row[-1]) < 0.3 * sum(got.values())


def test_tall_trees_of_uneven_heights(spark):
    """Five levels of one source, so that the salted jump takes part; lone leaves."""
    rows = spark.range(4200).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4100, "big").when(F.col("id") < 4180, F.concat(F.lit("s"), F.col("id"))).alias("source"),
        F.lit("en").alias("lang"),
        F.lit(3).cast("long").alias("n_chars"),
        F.concat(F.lit("Text "), F.col("id")).alias("text"),
    )
    check(rows)


def test_small_forests(spark):
    row = (1, "a", "en", 2, "Ab")
    for rows in ([row], [row, row], [row] * 17, [(i, str(i), None, None, None) for i in range(20)]):
        check(spark.createDataFrame(rows, DOCS))


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs)
    assert merkle.report(no_docs).count() == 0
    clash = odd_docs.selectExpr("*", "1 AS leaf", "2 AS place", "3 AS tree", "4 AS width", "5 AS position", "6 AS at")
    assert merkle.report(clash).count() == odd_docs.count()


def test_a_proof_of_another_row_does_not_verify(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = merkle.proofs(docs).select("leaf", "proof", "root").limit(2).collect()
    pair = spark.createDataFrame([(rows[0]["leaf"], rows[1]["proof"])], f"leaf string, proof {merkle._STEPS}")
    assert pair.select(merkle.folded(F.col("leaf"), F.col("proof"))).first()[0] != rows[0]["root"]
