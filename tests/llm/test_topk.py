"""Branch-and-bound search against all products."""

import math
import random

import numpy as np
import pytest

from roadframe.llm import topk_blocks

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, scale=1024, k=10, every=100):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(kept):
        if q is not None and q % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i) for other, (i, w) in enumerate(kept) if other != at]
            scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
            out += [(q, rank, i, -s if -s < 1 << 63 else None) for rank, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, **args):
    out = topk_blocks.search(spark.createDataFrame(rows, SCHEMA).repartition(4), **args)
    return sorted(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect()), key=str)


@pytest.mark.parametrize("queries", [8192, 7])
def test_against_all_products(spark, monkeypatch, queries):
    monkeypatch.setattr(topk_blocks, "CANDIDATES", 100)
    r = random.Random(queries)
    centres = [[r.gauss(0, 1) for _ in range(20)] for _ in range(5)]
    rows = [(i, [c + r.gauss(0, 0.3) for c in centres[i % 5]]) for i in range(900)]
    rows += [(i, rows[3][1]) for i in range(1000, 1040)]  # a hot vector: ties go by id
    assert run(spark, rows, every=50, queries=queries) == plain(rows, every=50)


def test_odd_vectors(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [1.0, -1.0, 4.0]), (1, []), (200, []), (2, None), (300, None), (400, [nan]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [1.0, 2.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-0.0001, -3.0]), (-100, [0.0, 0.0]), (9, [2.0])] + [(20 + i, [0.5, 0.5]) for i in range(15)]
    for k in (1, 3, 50):
        assert run(spark, rows, k=k) == plain(rows, k=k)


def test_large_components(spark):
    rows = [(100 * i, [1e3 * i, -2.5e14 * i, 7.0, 1e12]) for i in range(1, 15)] + [(i, [3e15, 1.0, -1e15, 0.001 * i]) for i in range(1, 30)]
    assert run(spark, rows, k=4) == plain(rows, k=4)


def test_few_rows_and_none(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(0, [1.0]), (1, [2.0])]) == plain([(0, [1.0]), (1, [2.0])])


def test_blocks_are_left_early():
    """Candidates far below the k-th place are dropped after the heaviest block, and the best stay."""
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.integers(500, 600, (20, 64)), rng.integers(-60, 60, (5000, 64))]).astype(float)
    block = topk_blocks.Columns(np.arange(5020), np.zeros(5020, bool), rows)
    query = np.concatenate([np.full(8, 900.0), np.full(56, 3.0)])
    touched = []
    plain_reach = topk_blocks.reach
    try:
        topk_blocks.reach = lambda rest, left: (touched.append(len(rest)), plain_reach(rest, left))[1]
        at, scores = block.best(query, 5, -np.inf)
    finally:
        topk_blocks.reach = plain_reach
    want = rows @ query
    order = np.lexsort((np.arange(5020), -want))[:5]
    assert sorted(at) == sorted(order) and (scores == want[at]).all()
    assert touched[0] == 5020 and touched[1] <= 40


def test_clashing_names(spark):
    names = ["vec", "query", "times", "own", "score", "n", "mine", "rank", "copy"]
    rows = [(50 * i, [float(i % 5), 1.0]) for i in range(30)]
    df = spark.createDataFrame([(*r, *["?"] * len(names)) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    assert sorted(map(tuple, topk_blocks.search(df).collect()), key=str) == plain(rows)
    other = spark.createDataFrame(rows, "query long, times array<double>")
    assert sorted(map(tuple, topk_blocks.search(other, "query", "times").collect()), key=str) == plain(rows)
