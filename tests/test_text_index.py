"""Search by trigrams against the plain search."""

import random
import re

import pytest

from marklens.operators import search, text_index
from samples import record, records

NAMES = [
    "Customer#000000001", "CUSTOMER#000000017", "anna Lee", "Anna", "Al", "", "Kelvin King", "İstanbul",
    "straße", "Miſter", "a.b*c+d", "customer#17", "x" * 40,
]
PATTERNS = [
    "er#0+1[0-9]*7$", "cust", "CUSTOMER", "an+a", "ann?a", "a\\.b\\*c", "(cus|ann)", "(anna) lee", "king", "istan",
    "str.*e", "mister", "^al$", "x{3}", "x{40}", "tom{1}er", "[ck]ust[o]mer", "\\d{3}", "\\Qa.b\\E", "(?i)anna", "1.",
    "omer#0*17", "ab", "", "anna\\s+lee", "customer#1+7", "lee$|king", "e{0}r#0",
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rows = [record(100 + i, name=name or None) for i, name in enumerate(NAMES)]
    rows += [(500, None, "Other", 80.0, 4.0, 1.0, 1.0, 1.0), (12345, "", "Other", 80.0, 4.0, 1.0, 1.0, 1.0)]
    df = records(spark, rows)
    path = str(tmp_path_factory.mktemp("index") / "i")
    text_index.build(df, path)
    return df, path


@pytest.mark.parametrize("literal", [False, True])
def test_equal_to_the_search(indexed, literal):
    df, path = indexed
    found = {}
    for query in [*PATTERNS, "ſter", "King", "234", "12345", "no such text"]:
        want = sorted(r.Student_ID for r in search.search(df, query, literal).collect())
        got = sorted(r.Student_ID for r in text_index.search_indexed(df, path, query, literal).collect())
        assert got == want, query
        found[query] = got
    assert found["cust"] and not found["no such text"] and 12345 in found["234"]


def test_runs_are_part_of_every_match():
    pick = random.Random(8)
    parts = ["ab", "c", "d+", "e*", "f?", "g{2}", "h{0,1}", "[ij]k", "(lm)n", "\\.", ".", "o\\d", "\\w*", "pq", "#"]
    for _ in range(300):
        pattern = "".join(pick.choices(parts, k=5))
        text = "".join(
            {"d+": "dd", "e*": "", "f?": "", "g{2}": "gg", "h{0,1}": "", "[ij]k": "ik", "(lm)n": "lmn", "\\.": ".",
             ".": "z", "o\\d": "o7", "\\w*": ""}.get(p, p)
            for p in re.findall("|".join(map(re.escape, sorted(parts, key=len, reverse=True))), pattern)
        )
        assert re.fullmatch(pattern, text)
        assert all(run in text for run in text_index.required_runs(pattern)), pattern


@pytest.mark.parametrize("pattern", ["a|b", "(?i)abc", "\\Qabc\\E", "\\x41bc", "[a[b]]cde", "(a(b))cde", "abc\\", "abc{2"])
def test_nothing_is_required_where_it_is_not_plain(pattern):
    assert text_index.required_runs(pattern) == []


def test_only_postings_of_the_query_are_read(indexed):
    df, path = indexed
    keys = text_index.candidate_keys(df.sparkSession, path, {"cus", "ust", "#00", "017", "er#"})
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "postings" in plan and "In(gram, [" in plan
    assert {r.Student_ID for r in keys.collect()} >= {101}


def test_a_task_has_few_postings(spark, tmp_path, monkeypatch):
    """Tasks grow in number with the table, to sort its postings as to group them."""
    monkeypatch.setattr(text_index, "PER_TASK", 100, raising=False)
    df = records(spark, [record(i, name=f"Customer#{i:06d}") for i in range(1000, 1200)])
    path = str(tmp_path / "i")
    text_index.build(df, path)
    files = spark.read.parquet(f"{path}/postings").groupBy("_metadata.file_path").count().collect()
    assert len(files) > 20 and max(r["count"] for r in files) <= 400
    keys = text_index.candidate_keys(spark, path, {"cus", "ust", "#00", "101"})
    assert sorted(r.Student_ID for r in keys.collect()) == sorted([1101, *range(1010, 1020)])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange") > plan.rindex("Aggregate")  # nothing is grouped where files are read
