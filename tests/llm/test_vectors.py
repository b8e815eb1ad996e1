"""Clustering and top-k search against plain numpy and plain Python."""

import hashlib
import random

import numpy as np
import pytest
from conftest_helpers import multiset
from feedhouse.llm import heap_clusters as hc
from feedhouse.llm import topk
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    # Names that the operators use inside.
    *[T.StructField(n, T.StringType()) for n in ("v", "cluster", "block", "score", "stripe", "label")],
])


def vectors(n: int, dimensions: int = 64, groups: int = 6, seed: int = 3) -> list[tuple]:
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(groups, dimensions))
    out = middles[draw.integers(groups, size=n)] + 0.1 * draw.normal(size=(n, dimensions))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]


def awkward(n: int) -> list[tuple]:
    """Repeated rows and ids, ties, nulls in any place, odd lengths, infinities, and components out of reach."""
    rows = vectors(n)
    rows += [rows[3], rows[0], rows[0], (50, rows[7][1]), (150, rows[7][1]), (None, rows[5][1]), (None, rows[8][1])]
    rows += [(9000 + i, rows[11][1]) for i in range(n // 3)]
    rows += [(8000, None), (8050, [1.0] * 63 + [None]), (8100, [float("nan")] * 64), (8150, [float("inf")] + [0.0] * 63),
             (8200, [1e30] + [0.0] * 63), (8250, [0.0] * 64)]
    random.Random(1).shuffle(rows)
    return rows


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, *["x"] * 6) for i, v in rows], SCHEMA).repartition(parts)


def fits(v, limit, lengths):
    return (v is not None and len(v) in lengths and all(x is not None and np.isfinite(x) for x in v)
            and all(abs(256 * x) < limit for x in v))


def whole(rows, limit=2.0**27, lengths=(64,)):
    held = [(i, v) for i, v in rows if fits(v, limit, lengths)]
    return [i for i, _ in held], [[int(np.floor(256 * x)) for x in v] for _, v in held]


def lloyd(ids, vecs, k=40, rounds=5):
    """Plain rounds over all vectors and centroids, in whole numbers."""
    order = sorted(range(len(ids)), key=lambda i: (
        hashlib.sha256(f"2:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), vecs[i]))[:k]
    points = np.array(vecs, dtype=np.int64)
    centres = points[order]
    for turn in range(rounds + 1):
        distances = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        label = distances.argmin(axis=1)
        if turn < rounds:
            centres = np.array([
                [int(s) // int((label == c).sum()) for s in points[label == c].sum(axis=0)] if (label == c).any() else at
                for c, at in enumerate(centres)])
    least = distances.min(axis=1)
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return [(ids[i], int(c), int(least[i]), int(least[label == c].sum()), int(least.sum()), names[c])
            for i, c in enumerate(label)]


@pytest.mark.parametrize("n", [30, 400])
def test_clusters_equal_plain_rounds(spark, n):
    rows = awkward(n)
    out = hc.with_inertia(*hc.cluster(table(spark, rows)))
    assert multiset(out.collect()) == multiset(lloyd(*whole(rows)))


def test_bounds_spare_vectors_and_change_nothing(spark):
    """Vectors in clear groups: after the first turns most gaps hold."""
    rows = vectors(3000, groups=8, seed=5)
    settings = hc.Settings(clusters=8, rounds=12)
    assigned, centroids = hc.cluster(table(spark, rows), settings)
    expected = lloyd(*whole(rows), k=8, rounds=12)
    assert multiset((r.vec_id, r.cluster, r.distance) for r in assigned.collect()) == multiset(e[:3] for e in expected)
    # Some groups have two first centroids, and their vectors small gaps; those of the others are spared.
    assert centroids.popped[0] == 3000 and centroids.popped[-1] < 1000


def test_large_components_stay_exact(spark):
    draw = random.Random(2)
    rows = [(i, [float(np.float32(draw.uniform(-500_000, 500_000))) for _ in range(64)]) for i in range(60)]
    ids, vecs = whole(rows)
    assigned, _ = hc.cluster(table(spark, rows), hc.Settings(clusters=5))
    # Distances by Python's whole numbers.
    found = {r.vec_id: (r.cluster, r.distance) for r in assigned.collect()}
    assert set(found) == set(ids)
    for a, b, d, *_ in lloyd(ids, vecs, k=5):
        assert found[a] == (b, d)


def test_tied_centroids_take_the_smaller_number():
    block = {"ids": b"", "absent": b"", "vectors": np.array([[0, 0], [4, 0]], np.int32).tobytes(),
             "labels": np.array([-1, -1], np.int32).tobytes(), "keys": b"", "places": b"", "sizes": b""}
    held = hc.Block(block, hc.Settings(dimensions=2))
    popped, before = held.assign(np.array([[2, 0], [-2, 0], [2, 0]]), np.zeros(3))
    assert popped.tolist() == [0, 1] and before.tolist() == [-1, -1] and held.labels.tolist() == [0, 0]


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        out = hc.with_inertia(*hc.cluster(table(spark, rows)))
        assert out.count() == 0
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def best(rows, every, k, lengths=range(10_000)):
    held = [(i, v) for i, v in rows if fits(v, 2.0**60, lengths)]
    held = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in held]
    held = [(i, v) for i, v in held if sum(x * x for x in v) < 2**62]
    out = []
    for q, (query_id, asked) in enumerate(held):
        if query_id is None or query_id % every:
            continue
        scores = [(-sum(a * b for a, b in zip(asked, v)), i is None, i or 0, i) for c, (i, v) in enumerate(held) if c != q]
        out += [(query_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return out


@pytest.mark.parametrize("settings", [topk.Settings(), topk.Settings(k=3, block_rows=16, chunk_queries=2)])
def test_top_rows_equal_all_scores(spark, settings):
    rows = awkward(200)
    out = topk.top_rows(table(spark, rows), 50, settings)
    assert multiset(out.collect()) == multiset(best(rows, 50, settings.k))


def test_sparse_rows_of_any_length(spark):
    draw = random.Random(6)
    rows = [(i, [draw.choice([0.0, 0.0, 0.0, -1.5, 2.25]) for _ in range(draw.choice([0, 3, 200]))]) for i in range(150)]
    rows += [(5000, [300_000.0] * 200), (5010, [-300_000.0] * 200)]
    out = topk.top_rows(table(spark, rows), 10, topk.Settings(block_rows=32))
    assert multiset(out.collect()) == multiset(best(rows, 10, 5))


def test_fewer_others_than_asked_for(spark):
    rows = [(0, [1.0] * 64), (1, [2.0] * 64), (50, [3.0] * 64)]
    assert multiset(topk.top_rows(table(spark, rows), 50).collect()) == multiset(best(rows, 50, 5))
    assert topk.top_rows(table(spark, rows[:1]), 50).count() == 0


def test_search_in_nothing(spark):
    for rows in ([], [(1, [1.0]), (3, [2.0])], [(50, None)]):
        out = topk.top_rows(table(spark, rows), 50)
        assert out.count() == 0 and out.columns == ["query_id", "rank", "vec_id", "score"]
