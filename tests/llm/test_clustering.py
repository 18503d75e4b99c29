"""Clusters against plain rounds over whole numbers, and the geometry by trial."""

import math
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from marklens.llm import clustering
from marklens.llm.clustering import Clustering, Move, sphere_bound

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, upper double"


def expected(rows, how=Clustering()):
    kept = [
        (i, [min(max(math.floor(how.scale * x), -(1 << 26)), 1 << 26) for x in v])
        for i, v in rows
        if v is not None and len(v) == how.length and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda r: sha256(f"{how.seed}{'' if r[0] is None else r[0]}".encode()).hexdigest()
    packed = lambda v: np.array(v, "<i4").tobytes()
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r), packed(r[1])))[: how.k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for t in range(how.rounds + 1):
        near = [min((apart(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if t < how.rounds:
            for j in range(len(centres)):
                own = [v for (_, v), n in zip(kept, near, strict=True) if n[1] == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted((str(i), j, d) for (i, _), (d, j) in zip(kept, near, strict=True)), centres


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, 0.5) for i, v in rows], SCHEMA)


def clusters(spark, rows, how):
    found, centres = clustering.cluster(frame(spark, rows).repartition(3), how)
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in found.collect()), centres.tolist()


def test_equal_to_plain_rounds(spark):
    pick = np.random.default_rng(3)
    places = pick.normal(size=(6, 4))
    rows = [(i, (places[i % 6] + pick.normal(size=4) * 0.4).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(50)] + [(1000, rows[9][1]), (None, rows[4][1])]
    how = Clustering(length=4)
    assert clusters(spark, rows, how) == expected(rows, how)


def test_ties_go_to_the_smaller_number(spark):
    """Few places on a grid: many vectors are as near to two centroids."""
    rows = [(i, [float(i % 5), float(i // 5 % 4)]) for i in range(200)]
    how = Clustering(length=2, k=6, scale=2)
    assert clusters(spark, rows, how) == expected(rows, how)


def test_odd_vectors(spark):
    good = [0.1, -0.2]
    rows = [
        (1, good), (1, good), (2, [1e300, -1e300]), (3, None), (4, []), (5, [0.1]), (6, [0.1, None]),
        (7, [0.1, float("nan")]), (8, [float("inf"), 0.0]), (None, good), (None, None), (9, [5.0, 5.0]),
    ]
    how = Clustering(length=2)
    got, centres = clusters(spark, rows, how)
    assert (got, centres) == expected(rows, how)
    assert len(got) == 5
    none = frame(spark, rows).filter("false")
    assert clustering.report(none, how).count() == 0
    assert clustering.report(frame(spark, rows), how).count() == 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=9, max_size=9), st.floats(0, 6), st.integers(0, 1 << 30))
def test_the_bound_holds_on_the_whole_sphere(numbers, radius, seed):
    centre, a, b = np.array(numbers).reshape(3, 3)
    if np.linalg.norm(b - a) < 1e-3:
        return
    bound = sphere_bound(centre, radius, a, b)
    assert 0 <= bound <= np.linalg.norm(b - a) + 1e-9
    points = np.random.default_rng(seed).normal(size=(300, 3))
    points = centre + points / np.linalg.norm(points, axis=1, keepdims=True) * radius
    nearer = np.linalg.norm(points - a, axis=1) - np.linalg.norm(points - b, axis=1)
    assert nearer.max() <= bound + 1e-7


def test_the_bound_is_less_than_the_drift():
    """A centroid that moves away, or past the sphere, costs little or nothing."""
    origin = np.zeros(2)
    away = sphere_bound(origin, 1.0, np.array([5.0, 0]), np.array([9.0, 0]))
    past = sphere_bound(origin, 1.0, np.array([-2.0, 10]), np.array([2.0, 10]))
    toward = sphere_bound(origin, 1.0, np.array([9.0, 0]), np.array([5.0, 0]))
    assert away == 0 and 0 < past < 0.15 * 4 and toward == 4


def test_sure_vectors_are_not_scanned(monkeypatch):
    pick = np.random.default_rng(5)
    before = np.array([[0, 0], [1000, 0], [0, 1000]])
    move = Move(before, before + np.array([[3, 1], [2, 2], [1, 3]]), np.array([80.0, 80.0, 80.0]))
    vectors = np.repeat(before, 100, axis=0) + pick.integers(-50, 50, (300, 2))
    import pyarrow as pa

    packed = pa.array([v.astype("<i4").tobytes() for v in vectors], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), packed], ["vec_id", "vector"])
    state = list(clustering._started([batch], before))
    monkeypatch.setattr(clustering, "_scanned", lambda *_: 1 / 0)
    moved = pa.Table.from_batches(clustering._moved(state, move))
    assert moved.column("cluster").to_pylist() == [0] * 100 + [1] * 100 + [2] * 100
