import zlib
from collections import defaultdict

from marklens.llm import sharding


def test_shards_hold_near_equal_bytes_without_gaps(spark, sf):
    from marklens.llm.queries import QUERIES

    rows = QUERIES["op1_virtual_slots"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    loads, places = defaultdict(int), defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert set(loads) <= set(range(40))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    mean, largest = sum(loads.values()) / 40, max(r["size"] for r in rows)
    assert max(loads.values()) <= max(largest, 1.1 * mean)


def test_rebalancing_moves_only_what_it_must():
    sizes = {s: 100 for s in range(400)}
    first = sharding.first_map(40, 400)
    assert sharding.rebalanced(first, sizes, 40) == first
    sizes[0] = 5000
    edited = sharding.rebalanced(first, sizes, 40)
    moved = [s for s in range(400) if edited[s] != first[s]]
    assert 0 < len(moved) < 60 and 0 not in moved


def test_one_more_shard_takes_slots_only_into_itself():
    sizes = {s: 1 + s % 7 for s in range(4000)}
    before = sharding.rebalanced(sharding.first_map(40, 4000), sizes, 40)
    after = sharding.grown(before, sizes, 40)
    moved = [s for s in range(4000) if after[s] != before[s]]
    assert {after[s] for s in moved} == {40}
    load = sum(sizes[s] for s in moved)
    assert abs(load - sum(sizes.values()) / 41) <= 7


def test_versions_stay(spark, tmp_path):
    path = str(tmp_path / "map")
    sharding.store_map(spark, path, [0, 1], 1)
    sharding.store_map(spark, path, [1, 1], 2)
    assert {r["shard"] for r in sharding.read_map(spark, path).collect()} == {1}
    assert {r["shard"] for r in sharding.read_map(spark, path, 1).collect()} == {0, 1}


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    rows = sharding.shard_by_bytes(odd_docs, str(tmp_path / "a"), 3, 64).collect()
    assert len(rows) == odd_docs.count()
    assert sharding.shard_by_bytes(no_docs, str(tmp_path / "b"), 3, 64).count() == 0


def test_a_stored_map_is_edited_into_the_next_version(spark, odd_docs, tmp_path):
    path = str(tmp_path / "map")
    first = sharding.shard_by_bytes(odd_docs, path, 3, 64)
    before = {r["virtual_slot"]: r["shard"] for r in first.collect()}
    version, shard_of = sharding.latest_map(spark, path, 64)
    long = " ".join(f"more{i}" for i in range(30_000))
    grown = odd_docs.unionByName(odd_docs.limit(1).selectExpr(
        "99L AS doc_id", f"'{long}' AS text", "lang", "source", "n_chars", "key"))
    rows = sharding.shard_by_bytes(grown, path, 3, 64, stored=True).collect()
    after = {r["virtual_slot"]: r["shard"] for r in rows}
    latest, edited = sharding.latest_map(spark, path, 64)
    assert latest == version + 1 and {r["version"] for r in rows} == {latest}
    assert any(shard_of[s] != edited[s] for s in range(64))
    assert all(edited[s] == shard for s, shard in after.items())
    assert all(before[s] == shard_of[s] for s in before)
    # Nothing to move: no version is added.
    again = sharding.shard_by_bytes(grown, path, 3, 64, stored=True).collect()
    assert {r["version"] for r in again} == {latest}


def test_large_slots_do_not_share_a_shard():
    sizes = {s: 10 for s in range(80)} | {0: 5000, 40: 4000, 41: 900}
    edited = sharding.rebalanced(sharding.first_map(40, 80), sizes, 40)
    load = defaultdict(int)
    for slot, size in sizes.items():
        load[edited[slot]] += size
    assert max(load.values()) == 5000 and edited[0] == 0
    assert sorted(load.values())[-2:] == [4000, 5000]
