"""Tables in versions: appends at the same time, lost writers, replays, file skipping."""

import random
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from marklens.operators import ingest
from marklens.sources import ledger
from marklens.streaming import submissions as stream
from samples import column, record, records, submitted

SF = "/root/testdata/sf0.001"


def batch(spark, keys, first=0, **fields):
    return submitted(spark, [{"Student_ID": str(k), "Ingest_Order": first + i, **fields} for i, k in enumerate(keys)])


def keys_of(spark, path):
    return sorted(column(ledger.read(spark, path), "Student_ID"))


def test_two_threads_store_each_key_once(spark, tmp_path, monkeypatch):
    """Both writers judge their batch by the same version before either commits."""
    path, both, commit = str(tmp_path / "t"), Barrier(2), ledger.commit
    met = []

    def commit_together(*args):
        if len(met) < 2:
            met.append(1)
            both.wait(60)
        return commit(*args)

    monkeypatch.setattr(ledger, "commit", commit_together)
    batches = [batch(spark, range(1, 60), Name="a"), batch(spark, range(40, 100), Name="b")]
    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(lambda b: ingest.append_committed(b, path), batches))
    assert sorted(versions) == [1, 2]
    assert keys_of(spark, path) == list(range(1, 100))
    names = {r.Student_ID: r.Name for r in ledger.read(spark, path).collect()}
    assert len({names[k] for k in range(40, 60)}) == 1 and names[1] == "a" and names[99] == "b"
    # The loser's first folder is gone, and each version reads as it was.
    assert len(list((tmp_path / "t").glob("data-*"))) == 2
    assert ledger.read(spark, path, number=1).count() in (59, 60)


def test_many_writers(spark, tmp_path):
    path, pick = str(tmp_path / "t"), random.Random(4)
    batches = [pick.sample(range(1, 40), 12) for _ in range(5)]
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda keys: ingest.append_committed(batch(spark, keys), path), batches))
    assert keys_of(spark, path) == sorted({k for keys in batches for k in keys})
    assert ledger.latest(spark, path).number == 5


def test_a_lost_writer_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ingest.append_committed(batch(spark, [1, 2]), path)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "create_new", fail)
        with pytest.raises(RuntimeError):
            ingest.append_committed(batch(spark, [3]), path)
    assert keys_of(spark, path) == [1, 2]
    ingest.append_committed(batch(spark, [3, 1]), path)
    assert keys_of(spark, path) == [1, 2, 3]


def test_a_version_is_never_replaced(spark, tmp_path):
    path = f"{tmp_path}/t/_versions/1.json"
    assert ledger.create_new(spark, path, "first") and not ledger.create_new(spark, path, "second")
    assert ledger.read_text(spark, path) == "first"
    assert [p.name for p in (tmp_path / "t" / "_versions").glob("*.draft")] == []


def test_equal_to_append_new(spark, tmp_path):
    """Batches one after the other are the same as all rows in their order."""
    rows = [
        {"Student_ID": "1", "Math": "200"}, {"Student_ID": "1", "Math": "20"}, {"Student_ID": "2"},
        {"Student_ID": "1", "Math": "30"}, {"Student_ID": "x"}, {"Student_ID": "2", "Name": " "}, {"Student_ID": "3"},
    ]
    whole = submitted(spark, rows)
    for low in (0, 2, 4, 6):
        part = whole.filter((F.col("Ingest_Order") >= low) & (F.col("Ingest_Order") < low + 2))
        ingest.append_committed(part, str(tmp_path / "t"))
    want = ingest.append_new(whole, records(spark, []))
    got = ledger.read(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("Student_ID = 1").first().Math == 20.0


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ingest.append_committed(batch(spark, [1]), path, stream="s", batch=0) == 1
    assert ingest.append_committed(batch(spark, [1, 9]), path, stream="s", batch=0) == 1
    assert ingest.append_committed(batch(spark, [2]), path, stream="s", batch=1) == 2
    assert ingest.append_committed(batch(spark, [5]), path, stream="other", batch=0) == 3
    assert keys_of(spark, path) == [1, 2, 5]


def test_a_stream_with_a_replayed_file(spark, tmp_path):
    """Three files, one a batch; the last batch is lost after its commit and run again."""
    inbox, path, checkpoint = (str(tmp_path / n) for n in ("inbox", "t", "checkpoint"))
    files = [batch(spark, [1, 2], 0), batch(spark, [2, 3], 10, Math="60"), batch(spark, [3, 4], 20, Math="70")]

    def run():
        arriving = stream.read_stream(spark, inbox, files_per_batch=1)
        stream.append_stream(arriving, path, checkpoint, "inbox").awaitTermination()

    for part in files:
        part.coalesce(1).write.mode("append").option("header", True).option("escape", '"').csv(inbox)
        run()
    noted = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for place in (noted, noted.with_name(f".{noted.name}.crc")):
        place.unlink(missing_ok=True)
    run()
    union = files[0].unionByName(files[1]).unionByName(files[2])
    want = ingest.append_new(union, records(spark, []))
    assert sorted(map(tuple, ledger.read(spark, path).collect())) == sorted(map(tuple, want.collect()))
    assert ledger.latest(spark, path).number == 3


def test_a_lookup_opens_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    table = records(spark, [record(k) for k in range(1, 4001)]).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        folder = ledger.write_folder(table, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ledger.commit(spark, path, ledger.Version().after(folder, None, None))
    ranges = ledger.file_ranges(spark, path).collect()
    assert len(ranges) == 8 and sum(r.records for r in ranges) == 4000
    found = ledger.read_range(spark, path, 1234, 1234)
    assert len(found.inputFiles()) == 1 and column(found, "Student_ID") == [1234]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Student_ID), GreaterThanOrEqual(Student_ID,1234)" in plan
    assert ledger.read_range(spark, path, 9000, 9001).count() == 0
    some = spark.createDataFrame([(5,), (7,), (None,), (7,)], "Student_ID long")
    assert sorted(column(ingest.existing_in_ranges(some, path), "Student_ID")) == [5, 7]
    assert ingest.existing_in_ranges(some.filter("Student_ID IS NULL"), path).count() == 0


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ledger.latest(spark, path) == ledger.Version()
    assert ledger.read(spark, path).count() == ledger.read_range(spark, path, 1, 2).count() == 0
    ingest.append_committed(batch(spark, []), path)
    assert ledger.read(spark, path).count() == 0
