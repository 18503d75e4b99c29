import re

from marklens.llm import decontamination as dc

ITEM = (
    "A train leaves the station at 60 mph and travels for 3 hours before it stops. "
    "If the train at 60 mph went on for 3 hours more, how far would Alice have to walk back?"
)
OTHER = ITEM.replace("60", "85").replace("3 hours", "7 hours").replace("Alice", "Robert")
UNEVEN = OTHER.replace("at 85 mph went", "at 99 mph went")


def flagged(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "too short")], "item_id long, text string")
    return {r["doc_id"]: r["contaminated"] for r in dc.report(docs, items).collect()}


def test_questions_asked_anew(spark):
    filler = "nothing of interest stands here and nothing will. "
    got = flagged(
        spark,
        [
            filler + ITEM + " " + filler,
            filler + OTHER + filler,
            filler + UNEVEN + filler,
            filler * 40,
            ITEM.upper(),
            " ".join(ITEM.split()[:10]),
            None,
        ],
    )
    assert got == {0: True, 1: True, 2: False, 3: False, 4: True, 5: False, 6: False}


def test_verbatim_items_are_found_and_clean_texts_left(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {r["doc_id"] for r in dc.report(docs, items).filter("contaminated").collect()}
    words = {r["item_id"]: re.findall(r"\w+", r["text"].lower()) for r in items.collect()}
    grams = {tuple(w[i : i + 8]) for w in words.values() for i in range(len(w) - 7)}
    for r in docs.collect():
        own = re.findall(r"\w+", r["text"].lower())
        shared = sum(tuple(own[i : i + 8]) in grams for i in range(len(own) - 7))
        assert (r["doc_id"] in found) == (shared >= 6)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    report = dc.report(odd_docs, items).collect()
    assert len(report) == odd_docs.count()
    assert {r["doc_id"] for r in report if r["contaminated"]} == {1, 2}
    kept = dc.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert dc.report(no_docs, items).count() == 0
    assert dc.clean(odd_docs, items.filter("false")).count() == odd_docs.count()


def test_values_that_meet_or_change_their_length(spark):
    item = "Yesterday Tom had 5 apples and Ann bought 7 more of them. How many apples does he have now?"
    texts = [
        item.replace("5", "4").replace("7", "4"),
        item.replace("5", "1,250").replace("7", "3.5"),
        item.replace("Ann", "Mary Ann"),
        item.replace("7", "1/2"),
        "An unlike text with 5 apples in it, and 7 more, that asks for nothing at all.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r["contaminated"] for r in dc.report(docs, items).collect()}
    assert found == {0: True, 1: True, 2: True, 3: True, 4: False}
    short = "Tom has 5 apples and buys 7 more. How many apples does he have now?"
    texts = [short.replace("5", a).replace("7", b) for a, b in (("4", "4"), ("1,250", "3.5"))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, short)], "item_id long, text string")
    assert dc.clean(docs, items).count() == 0


def test_repeated_rows_change_nothing(spark):
    filler = "nothing of interest stands here and nothing will"
    nine = " ".join(ITEM.split()[10:19])
    copy = "The quick brown fox jumps over the lazy dog"
    texts = [(1, f"{filler} {nine} {filler}")] * 2 + [(None, f"{nine} {filler}")] * 9 + [(3, copy), (4, copy[:20])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = [(7, ITEM), (8, copy), (8, copy), (None, copy)]
    for more in (rows, rows[3:]):
        items = spark.createDataFrame(more, "item_id long, text string")
        found = {(r["doc_id"], r["contaminated"], tuple(r["items"])) for r in dc.report(docs, items).collect()}
        named = (8,) if more is rows else ()
        assert found == {(1, False, ()), (None, False, ()), (3, True, named), (4, False, ())}


def test_short_items_and_items_of_numbers_are_found_as_they_stand(spark):
    rows = [
        (1, "Who wrote War and Peace?"),
        (2, "Compute 12 + 34 * 56 - 78 / 9 + 10"),
        (3, "Pi?"),
        (4, "..."),
    ]
    texts = [
        "Asked was: who wrote War and Peace? And then",
        "Now compute 12 + 34 * 56 - 78 / 9 + 10",
        "Now compute 12 + 34 * 56 - 78 / 9 + 11",
        "Who wrote the War and Peace?",
        "He wrote War and Peace... who",
        "about pi",
        "compute 12 + 34 * 56 - 78 / 9. Once 34 * 56 - 78 / 9 + 10",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = {r["doc_id"]: r["items"] for r in dc.report(docs, items).collect()}
    assert found == {0: [1], 1: [2], 2: [], 3: [], 4: [], 5: [3], 6: []}
    assert {r["doc_id"] for r in dc.clean(docs, items).collect()} == {2, 3, 4, 6}


def found(spark, items, texts):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in dc.report(docs, benchmark, dc.PRODUCTION).collect()}


def test_every_slot_of_a_window_is_compared(spark):
    item = (
        "the long walk home starts with 15 small steps over the old stone bridge and then "
        "it ends behind the mill after exactly 15"
    )
    other = item[:-2] + "92"
    asked_anew = item.replace("15", "40")
    got = found(spark, [item], [item, other, asked_anew])
    # The last value differs from the first: only the windows before it stay consistent.
    assert got[0]["contaminated"] and got[2]["contaminated"]
    assert got[0]["aligned"] == got[2]["aligned"] > 0
    assert not got[1]["contaminated"]


def test_very_short_items_are_mentions_within_longer_texts(spark):
    got = found(spark, ["Paris", "Who wrote it", "Two words"], [
        "He said paris is nice", "Paris", "ask who wrote it today", "two words", "some two words more", None, "",
    ])
    assert [got[i]["contaminated"] for i in range(7)] == [False, True, True, True, False, False, False]
    assert [got[i]["mentions"] for i in range(7)] == [[0], [], [], [], [2], [], []]
    assert got[2]["items"] == [1]
