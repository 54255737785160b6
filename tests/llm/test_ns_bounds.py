"""Clustering with ns-bounds against rounds that measure everything."""

import hashlib
import math
import random

import numpy as np
import pytest

from roadframe.llm import ns_bounds

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, dim, scale, rounds):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:k]
    centroids = [v for _, v in start]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centroids)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = {j: sum(d for _, c, d in placed if c == j) for j in {p[1] for p in placed}}
    fit = lambda x: x if x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, fit(d), fit(per[j]), fit(sum(per.values())), sha[j]) for i, j, d in placed), key=str)


def run(spark, rows, **args):
    out = ns_bounds.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3), **args)
    return sorted(map(tuple, out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_against_all_distances(spark, rounds):
    r = random.Random(rounds)
    rows = [(i, [r.gauss(3 * (i % 4), 1) for _ in range(5)]) for i in range(400)]
    assert run(spark, rows, k=7, dim=5, scale=8, rounds=rounds) == plain(rows, 7, 5, 8, rounds)


def test_odd_vectors(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, None), (2, [1.0]), (3, [1.0, None]), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [-inf, 1.0]), (None, [0.5, -0.25]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (7, [-0.001, 2.0]),
            (8, [0.5, 0.5]), (9, [3.0, 3.0]), (9, [-1e-20, 0.0]), (None, [9.0, 9.0])] + [(20 + i, [1.0, 1.0]) for i in range(30)]
    for k in (2, 4, 100):
        assert run(spark, rows, k=k, dim=2, scale=4, rounds=3) == plain(rows, k, 2, 4, 3)


def test_large_components(spark):
    rows = [(i, [x * s for x in (1.0 + i, -2.0 * i, 0.3)]) for i, s in enumerate([1.0, 1e7, 1e9, 1e12, 1e18, -1e18, 1e7, 2.0])]
    assert run(spark, rows, k=3, dim=3, scale=64, rounds=3) == plain(rows, 3, 3, 64, 3)


def test_nothing_to_start_with(spark):
    assert run(spark, [], k=3, dim=2) == [] and run(spark, [(None, [1.0, 2.0])], k=3, dim=2) == []


def test_bounds_save_measurements_and_are_looser_by_one_norm():
    """Centroids that go and come back leave stored distances as they were, so nothing is measured."""
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (500, 4))
    c0 = x[:6].tolist()
    away = [[v + 40 for v in c] for c in c0]
    history = ns_bounds.History([c0])
    cluster, seen, at = history.first(x)
    there_and_back = ns_bounds.History([c0, away, c0])
    assert (there_and_back.far[0] == 0).all() and (there_and_back.far[1] > 0).all()
    before = cluster.copy()
    strict = np.sort(seen, axis=1)
    clear = strict[:, 0] < strict[:, 1] * (1 - 1e-6)
    x, cluster, seen, at = x[clear], cluster[clear], seen[clear], at[clear]
    assert there_and_back.assign(x, cluster, seen, at) == 0 and (cluster == before[clear]).all()
    moved = ns_bounds.History([c0, away])
    measured = moved.assign(x, cluster, seen, at)
    assert 0 < measured < len(x) * 7
    full = np.stack([ns_bounds.squared(x, c) for c in moved.now], axis=1)
    assert (cluster == full.argmin(axis=1)).all()


def test_clashing_names(spark):
    names = ["vec", "cluster", "seen", "at", "side", "sums", "moved", "distance", "h", "exact", "inertia"]
    rows = [(i, [float(i % 5), 1.0]) for i in range(50)]
    df = spark.createDataFrame([(*r, *["?"] * len(names)) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    assert sorted(map(tuple, ns_bounds.cluster(df, k=3, dim=2).collect()), key=str) == plain(rows, 3, 2, 64, 3)
    other = spark.createDataFrame(rows, "cluster long, seen array<double>")
    assert sorted(map(tuple, ns_bounds.cluster(other, "cluster", "seen", k=3, dim=2).collect()), key=str) == plain(rows, 3, 2, 64, 3)
