import re

from marklens.llm import licenses

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = licenses.MORE[10][0]

TEXTS = [
    "CC-BY 4.0, cc by cc BY. All Rights Reserved; General Public License",
    "cc by",
    "all rights",
    "reserved all rights\nreserved",
    "",
    None,
    "Permission " + MIT.split(" ", 1)[1],
    " ".join(w for i, w in enumerate(MIT.split()) if i not in (9, 20)),
    "x " + " and then ".join(MIT.split()[:20:4]),
    "über cc by été",
]


def places(words):
    return [
        (k, label)
        for phrase, label in licenses.BASE
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]


def test_base_places_like_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in licenses.report(docs).collect():
        words = WORD.findall((TEXTS[r["doc_id"]] or "").translate(LOW))
        found = places(words)
        starts = [k for k, _ in found]
        assert (r["n_words"], r["n_base"]) == (len(words), len(found))
        assert r["first_word"] == min(starts, default=None)
        assert r["last_word"] == max(starts, default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in found}))


def test_longer_texts_with_gaps(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.report(docs).collect()}
    assert labels[6] == ("mit", 1.0)
    assert labels[7][0] == "mit" and 0.7 <= labels[7][1] < 1
    assert labels[8] == ("", 0.0)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = licenses.report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r["labels"] for r in rows if r["doc_id"] == 8] == ["reserved"]
    assert {r["n_words"] for r in rows if r["doc_id"] == 5} == {20_000}
    assert licenses.report(no_docs).count() == 0
