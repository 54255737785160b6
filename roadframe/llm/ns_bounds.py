"""Exact centroid clustering with ns-bounds (the norm of a sum of moves, not a sum of norms).

Components are integers (``floor(scale * x)``), and so are distances and centroids.
A vector keeps, for each centroid, the distance measured last and the round of that
measurement. The history of all centroids is kept, so a later round loosens each
stored distance by how far that centroid stands from where it was measured: one
norm of the whole displacement, which is at most the sum of the rounds' drifts and
mostly far less. A vector whose loosened upper bound to its own centroid stays
below all loosened lower bounds keeps its centroid without a distance. The others
measure their own centroid, then each centroid whose bound is not above it, exactly.

A round is one map over the staged state (vector, cluster, measured distances,
rounds), which is written as the next state together with each task's sums of the
vectors that moved, so centroids follow from ``k`` small rows of differences.
Centroids, their history and the sums are the only things that pass the driver:
``k * dim`` numbers a round, parameters both. No vector is shuffled.

Bounds are floats with a margin far above their rounding; they only say what is
measured. Distances that decide are exact: longs while components stay below 2^25,
Python's integers beyond.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component are left out; repeated rows are vectors of their own; rows of
null id are clustered but never start a centroid; equal ids tie by their vectors;
ties between centroids go to the smaller number; fewer than ``k`` vectors with ids
start as many centroids; without any start there are no rows; distances beyond a
long are null; components beyond 10^27 in sum are an error; an empty table gives
no rows; only the two named columns are read, so further columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

K, DIM, SCALE, ROUNDS = 16, 64, 64, 3
#: Components up to here have squared distances that fit a long (in up to 2^10 dimensions).
NARROW = 1 << 25
#: Relative slack of float bounds, far above the rounding of a square root and of a difference.
SLACK = 1e-9
LONGEST = (1 << 63) - 1

_STATE = "vec_id long, vec array<double>, cluster int, seen array<double>, at array<int>, side int, sums array<decimal(38,0)>, moved long"
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integers(values: np.ndarray) -> np.ndarray:
    """Whole floats as longs, or as Python's integers where longs might overflow later."""
    if values.size == 0 or np.abs(values).max() < NARROW:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def common_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a, b) if a.dtype == b.dtype else (a.astype(object), b.astype(object))


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid."""
    x, centroid = common_kind(x, centroid)
    gap = x - centroid
    return (gap * gap).sum(axis=1)


class History:
    """Centroids of all rounds so far (exact), and how far each stands from where it was in every earlier round."""

    def __init__(self, rounds: list[list[list[int]]]):
        wide = any(abs(x) >= NARROW for r in rounds for c in r for x in c)
        self.rounds = [np.array(r, object if wide else np.int64) for r in rounds]
        self.now = self.rounds[-1]
        self.far = np.array([[float(x) ** 0.5 for x in ((self.now - r) ** 2).sum(axis=1)] for r in self.rounds]) * (1 + SLACK)

    def assign(self, x: np.ndarray, cluster: np.ndarray, seen: np.ndarray, at: np.ndarray) -> int:
        """Bring clusters, measured distances and rounds up to date, in place. Returns the number of measurements."""
        n, k = seen.shape
        t, rows, measured = len(self.rounds) - 1, np.arange(n), 0
        drift = self.far[at, np.arange(k)[None, :]]
        lower = seen * (1 - SLACK) - drift
        upper = seen[rows, cluster] * (1 + SLACK) + drift[rows, cluster]
        lower[rows, cluster] = np.inf
        failing = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        if not len(failing):
            return 0
        exact = np.zeros(len(failing), object if x.dtype == object or self.now.dtype == object else np.int64)
        for j in range(k):
            mine = cluster[failing] == j
            if mine.any():
                exact[mine] = squared(x[failing[mine]], self.now[j])
                measured += int(mine.sum())
        own = np.sqrt(exact.astype(float))
        seen[failing, cluster[failing]], at[failing, cluster[failing]] = own, t
        open_ = lower[failing] <= (own * (1 + SLACK))[:, None]
        best, nearest = exact.copy(), cluster[failing].copy()
        for j in range(k):
            some = np.flatnonzero(open_[:, j])
            if len(some):
                d = squared(x[failing[some]], self.now[j])
                measured += len(some)
                seen[failing[some], j], at[failing[some], j] = np.sqrt(d.astype(float)), t
                better = (d < best[some]) | ((d == best[some]) & (j < nearest[some]))
                best[some[better]], nearest[some[better]] = d[better], j
        cluster[failing] = nearest
        return measured

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Clusters, distances and rounds of vectors that have none yet: all measured."""
        all_ = np.stack([squared(x, c) for c in self.now], axis=1) if len(x) else np.zeros((0, len(self.now)), np.int64)
        return np.argmin(all_, axis=1).astype(np.int64), np.sqrt(all_.astype(float)), np.full(all_.shape, len(self.rounds) - 1, np.int64)


def _matrix(b: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return common.column(b, name).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width).copy()


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel(), kind))


def _round(state: DataFrame, rounds: list, dim: int, begin: bool) -> DataFrame:
    """The next state (side 0) and, of each task, the sums of what came and went by cluster (side 1)."""
    k, sent = len(rounds[0]), state.sparkSession.sparkContext.broadcast(rounds)
    names = ["vec_id", "vec", "cluster", "seen", "at", "side", "sums", "moved"]
    kinds = [pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.decimal128(38, 0)), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = History(sent.value)
        sums, count = [[0] * dim for _ in range(k)], [0] * k
        for b in batches:
            if not b.num_rows:
                continue
            raw = _matrix(b, "vec", dim)
            x = integers(raw)
            if begin:
                before = np.full(b.num_rows, -1)
                cluster, seen, at = history.first(x)
            else:
                before = common.column(b, "cluster").to_numpy().astype(np.int64)
                cluster, seen, at = before.copy(), _matrix(b, "seen", k), _matrix(b, "at", k).astype(np.int64)
                history.assign(x, cluster, seen, at)
            for sign, side in ((1, cluster), (-1, before)):
                for j in np.unique(side[cluster != before]):
                    if j >= 0:
                        mine = (side == j) & (cluster != before)
                        sums[j] = [a + sign * int(s) for a, s in zip(sums[j], x[mine].sum(axis=0), strict=True)]
                        count[j] += sign * int(mine.sum())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([
                common.column(b, "vec_id"), common.column(b, "vec"), pa.array(cluster, pa.int32()), _lists(seen, pa.float64()), _lists(at, pa.int32()),
                pa.array(np.zeros(n, np.int32)), pa.nulls(n, kinds[6]), pa.nulls(n, kinds[7])], names=names)
        changed = [j for j in range(k) if count[j] or any(sums[j])]
        if changed:
            n = len(changed)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.array(changed, kinds[2]), pa.nulls(n, kinds[3]), pa.nulls(n, kinds[4]),
                pa.array([1] * n, kinds[5]), pa.array([[Decimal(s) for s in sums[j]] for j in changed], kinds[6]), pa.array([count[j] for j in changed], kinds[7])], names=names)

    return state.mapInArrow(run, _STATE)


def _staged(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass, written once: the state, and the tasks' sums (of whose columns the state's rows are null)."""
    both = common.stage(df, "ns-bounds")
    return both.where("side = 0"), both.where("side = 1").select("cluster", "sums", "moved")


def usable(vec: str, dim: int) -> Column:
    """Whether a vector has ``dim`` components, none null or non-finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == dim) & finite, F.lit(False))


def whole_part(x: Column) -> Column:
    """floor(x) as a double; doubles from 2^53 on are whole, and may be beyond the longs that floor() gives."""
    return F.when(F.abs(x) < F.lit(float(1 << 53)), F.floor(x).cast("double")).otherwise(x)


def cluster(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = df.sparkSession
    common.bounded_batches(spark, 4096)
    whole = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vec}`").cast("array<double>").alias("vec")).where(usable("vec", dim))
    vecs = whole.select("vec_id", F.transform("vec", lambda x: whole_part(F.lit(float(scale)) * x)).alias("vec"))
    start = vecs.where("vec_id is not null").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h"), "vec")
    history = [[[int(x) for x in r.vec] for r in start.orderBy("h", "vec").limit(k).collect()]]
    if not history[0]:
        return spark.createDataFrame([], _RESULT)
    total, count = [[0] * dim for _ in history[0]], [0] * len(history[0])
    state = vecs
    for t in range(rounds):
        state, moves = _staged(_round(state, history, dim, begin=t == 0))
        added = moves.groupBy("cluster").agg(F.sum("moved").alias("moved"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dim)])
        for r in added.collect():
            total[r.cluster] = [a + int(r[f"s{i}"]) for i, a in enumerate(total[r.cluster])]
            count[r.cluster] += r.moved
        history.append([[s // count[j] for s in total[j]] if count[j] else history[-1][j] for j in range(len(total))])
    state, _ = _staged(_round(state, history, dim, begin=rounds == 0))
    return _result(state, history, dim)


def _result(state: DataFrame, history: list, dim: int) -> DataFrame:
    spark, final = state.sparkSession, history[-1]
    sent = spark.sparkContext.broadcast(final)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = History([sent.value]).now
        for b in batches:
            if b.num_rows:
                x, own = common_kind(integers(_matrix(b, "vec", dim)), now)
                gap = x - own[common.column(b, "cluster").to_numpy()]
                d = [Decimal(int(v)) for v in (gap * gap).sum(axis=1)]
                yield pa.RecordBatch.from_arrays([common.column(b, "vec_id"), common.column(b, "cluster"), pa.array(d, pa.decimal128(38, 0))], names=["vec_id", "cluster", "exact"])

    placed = common.stage(state.select("vec_id", "vec", "cluster").mapInArrow(run, "vec_id long, cluster int, exact decimal(38,0)"), "placed")
    # as many rows as centroids
    per = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum("exact").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    long = lambda v: v if v <= LONGEST else None
    facts = [(j, long(per[j]), long(sum(per.values())), digest[j]) for j in sorted(per)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", F.expr("try_cast(exact as bigint)").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS) -> str:
    """All rounds one after the other, each with every distance."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"d{t} AS MATERIALIZED (SELECT v.r, c.j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{t} c ON c.i = v.i GROUP BY v.r, c.j)")
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, j, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, j) AS n FROM d{t}) WHERE n = 1)")
        if t < rounds:
            steps.append(f"m{t} AS (SELECT a.j, v.i, sum(v.x) AS s, count(*) AS n FROM a{t} a JOIN v ON v.r = a.r GROUP BY a.j, v.i)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT c.j, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{t} c LEFT JOIN m{t} m ON m.j = c.j AND m.i = c.i)")
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {dim}),
kept AS MATERIALIZED (SELECT * FROM e WHERE r NOT IN (SELECT r FROM (SELECT r, unnest(embedding) AS x FROM e) WHERE x IS NULL OR NOT isfinite(x))),
v AS MATERIALIZED (SELECT r, i, CAST(floor({scale} * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x FROM (SELECT r, embedding, unnest(range(1, {dim} + 1)) AS i FROM kept)),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS j FROM kept WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT s.j, v.i, v.x FROM s JOIN v ON v.r = s.r WHERE s.j < {k}),
{', '.join(steps)},
h AS (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY j)
SELECT kept.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM a{rounds} a JOIN kept ON kept.r = a.r JOIN h ON h.j = a.j
"""


@register("op12_ns_bounds", oracle())
def op12_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 centroids of all embeddings, 3 rounds."""
    return cluster(read_table(spark, sf_dir, "embeddings"))
