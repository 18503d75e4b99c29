"""Held-out accuracy of what is trained here, and the shrinkage of priors."""

import numpy as np
from pyspark.sql import functions as F

from marklens.llm import language, quality

SF = "/root/testdata/sf0.01"


def test_quality_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, known.filter("doc_id % 2 = 0"), docs["source"], docs["lang"])
    got = scored.select("row.doc_id", (F.col("probability") >= 0.5).cast("int").alias("good"))
    rows = got.join(known.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert len(rows) > 150
    assert np.mean([r["good"] == r["label"] for r in rows]) > 0.97


def test_sparse_sites_follow_the_group_above(spark):
    rows = [("big", "a", 4.0)] * 300 + [("big", "b", 4.0)] + [("bad", "a", -4.0)] * 300
    rows += [("bad", "c", 4.0), ("new", "a", -4.0)]
    sites = spark.createDataFrame(rows, "host string, path string, evidence double")
    model = quality.Classifier(np.zeros(1), np.ones(1), np.zeros(2), 0.0)
    rates = {(r["host"], r["path"]): r for r in quality.site_rates(sites, model).collect()}
    assert rates["big", "a"]["path_rate"] > 0.9 > 0.1 > rates["bad", "a"]["path_rate"]
    # One good document on a bad host is pulled down, the other way round less so.
    assert rates["bad", "c"]["path_rate"] < rates["big", "b"]["path_rate"]
    assert rates["new", "a"]["path_rate"] > rates["bad", "a"]["path_rate"]


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, None), (None, 1)], "doc_id long, label int")
    kept = quality.good_documents(odd_docs, labels, odd_docs["source"], odd_docs["lang"], 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    none = labels.filter("false")
    assert quality.score(odd_docs, none, odd_docs["source"], odd_docs["lang"]).count() == odd_docs.count()
    assert quality.score(no_docs, labels, no_docs["source"], no_docs["lang"]).count() == 0


def test_language_of_pages(spark):
    pages, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "documents"))
    rows = language.identify(pages, docs).collect()
    assert len(rows) == pages.count()
    in_path = [(r["url"].split("/")[3], r["language"]) for r in rows]
    assert np.mean([a == b for a, b in in_path]) > 0.98


def test_evidence_adds_up(spark):
    """Without any text, declaration and host decide; a strong text outvotes them."""
    english = "the and with from this that have been would there which their about"
    german = "der die und mit von nicht eine auch werden sich haben wurde durch"
    labelled = spark.createDataFrame([(english, "en"), (german, "de")] * 20, "text string, lang string")
    page = '<html lang="{}"><script>the the</script><p>{}</p></html>'
    rows = [(i, f"http://a.example.de/{i}", page.format("de", german)) for i in range(30)]
    rows += [(100 + i, f"http://b.example.uk/{i}", page.format("en", english)) for i in range(30)]
    rows += [(200, "http://a.example.de/x", page.format("de", "")), (201, "http://b.example.uk/x", "")]
    rows += [(202, "http://a.example.de/y", page.format("de", english * 3)), (203, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in language.identify(pages, labelled).collect()}
    assert [found[i]["language"] for i in (0, 100, 200, 201, 202)] == ["de", "en", "de", "en", "en"]
    assert found[200]["text_language"] is None and found[203]["language"] is not None
    assert language.identify(pages.filter("false"), labelled).count() == 0
    assert language.identify(pages, labelled.filter("false")).count() == len(rows)
