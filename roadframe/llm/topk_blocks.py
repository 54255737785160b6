"""Exact top-k search by branch and bound over dimension blocks (vertical layout).

The stated query set is searched against all rows. A task turns a block of
candidates into columns: one contiguous array a dimension, and for every block of
dimensions the norm of what is left of each candidate. For a query, dimension
blocks are taken in the order of the query's mass. After each block a candidate's
score lies within its sum so far plus or minus (mass left in the query) * (mass
left in the candidate), by Cauchy and Schwarz. Candidates whose upper end is below
the best known lower end of the k-th place are dropped and the columns of the rest
compacted, so later blocks touch survivors only.

The k-th place's lower end starts from the query block itself: its first
``SEEDS`` queries are candidates too, so the k-th best score among them is one that
the result must reach. A task so passes on few rows, and never more than ``k + 1``
for a query; the best of all tasks follow from one ranked window, which Spark cuts
to ``k + 1`` rows a query before the shuffle.

Queries are broadcast in blocks of ``QUERIES`` rows, one pass over the staged
vectors for each, so what is broadcast does not grow with the data. Equal rows of
the query set are searched once. Candidates are never shuffled.

Scores are exact: floats are used only while every sum of products stays below
2^53, Python's integers beyond. Bounds carry a margin for their rounding.

Defined cases: vectors that are null or hold null or non-finite components take no
part; vectors of different lengths are compared over the components both have (an
empty one scores 0); a query's own row is left out once, so another row of the same
id and vector is a candidate; repeated query rows have a result each; candidates of
null id come after all ids of the same score and null ids are no queries; scores
beyond a long are null; fewer than ``k`` candidates give as many rows; an empty
table gives none; only the two named columns are read, so further columns can't
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadframe.llm import common
from roadframe.llm.ns_bounds import whole_part
from roadframe.llm.registry import register
from roadframe.session import read_table

SCALE, TOP, EVERY = 1024, 10, 100
#: Rows of the query set in one pass, queries that the first thresholds come from, candidates and dimensions of a block.
QUERIES, SEEDS, CANDIDATES, DIMS = 8192, 1024, 16384, 8
EXACT = float(1 << 53)
#: Slack of float bounds, and the share of a mass that its rounding may have taken away at most.
SLACK, TINY = 1e-9, 1e-12

_FOUND = "query long, query_id long, times long, vec_id long, own boolean, score decimal(38,0)"


def exact_kind(values: np.ndarray, most: float) -> np.ndarray:
    """Whole floats as they are if products with components up to ``most`` add up exactly, else as Python's integers."""
    if not values.size or np.abs(values).max() * most * values.shape[-1] < EXACT:
        return values
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def reach(rest: np.ndarray, left: float) -> np.ndarray:
    """The most that what is left can add to a score, or take from it."""
    return np.sqrt(rest) * (left ** 0.5 * (1 + SLACK)) + 1 if left > 0 else np.ones(len(rest))


class Columns:
    """A block of candidates of one length, dimension by dimension."""

    def __init__(self, ids: np.ndarray, nameless: np.ndarray, rows: np.ndarray):
        self.ids, self.nameless = ids, nameless
        self.columns = np.ascontiguousarray(rows.T)
        self.most = float(np.abs(rows).max()) if rows.size else 0.0
        self.blocks = [np.arange(d, min(d + DIMS, rows.shape[1])) for d in range(0, rows.shape[1], DIMS)]
        self.mass = [(self.columns[b] * self.columns[b]).sum(axis=0) for b in self.blocks]

    def best(self, query: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(positions, exact scores) of the k best candidates of at least ``floor``, in any order; ties at the k-th place by id."""
        n, width = self.columns.shape[1], min(len(query), self.columns.shape[0])
        query = query[:width]
        blocks = [(query[b[b < width]], i) for i, b in enumerate(self.blocks) if b[0] < width]
        blocks.sort(key=lambda b: -float((b[0] * b[0]).sum()))
        columns = self.columns if exact_kind(query, self.most) is query else exact_kind(self.columns.T, np.inf).T
        alive, whole, sums = np.arange(n), True, np.zeros(n, columns.dtype)
        if columns.dtype == object:  # too large for floats: every sum in full
            for part, i in blocks:
                sums = sums + sum(int(c) * columns[DIMS * i + d] for d, c in enumerate(part))
            blocks = []
        left, rest = float((query * query).sum()), sum((self.mass[i] for _, i in blocks), np.zeros(n))
        if blocks and floor > -np.inf:
            alive = np.flatnonzero(reach(rest, left) >= floor)
            sums, rest, whole = sums[alive], rest[alive], len(alive) == n
        little, least = rest * TINY, left * TINY
        for part, i in blocks:
            if not len(alive):
                break
            these = slice(DIMS * i, DIMS * i + len(part))
            sums = sums + part @ (self.columns[these] if whole else self.columns[these][:, alive])
            left -= float((part * part).sum())
            rest = rest - (self.mass[i] if whole else self.mass[i][alive])
            spread = reach(np.maximum(rest, 0) + little, max(left, 0) + least)
            if len(alive) > k:
                low = sums - spread
                floor = max(floor, float(np.partition(low, len(low) - k)[len(low) - k]))
            stay = sums + spread >= floor
            if not stay.all():
                alive, sums, rest, little, whole = alive[stay], sums[stay], rest[stay], little[stay], False
        if len(alive) > k:
            tied = np.flatnonzero(sums >= np.sort(sums)[len(sums) - k])
            best = sorted(tied, key=lambda a: (-sums[a], self.nameless[alive[a]], self.ids[alive[a]]))[:k]
            alive, sums = alive[best], sums[best]
        return alive, sums


def seeds(queries: list[np.ndarray], k: int) -> list[float]:
    """For each query a score that the k-th best among the first queries of its block reaches, or minus infinity."""
    most, longest = max(float(np.abs(q).max()) if len(q) else 0.0 for q in queries), max(map(len, queries))
    if min(len(queries), SEEDS) < k or not most * most * longest < EXACT:
        return [-np.inf] * len(queries)
    by_length: dict[int, list[np.ndarray]] = {}
    for q in queries[:SEEDS]:
        by_length.setdefault(len(q), []).append(q)
    first = [np.stack(rows) for rows in by_length.values()]
    scores = (np.concatenate([m[:, : len(q)] @ q[: m.shape[1]] for m in first]) for q in queries)
    return [float(np.partition(x, len(x) - k)[len(x) - k]) for x in scores]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
    """Candidates of one length each, at most ``CANDIDATES`` at a time."""
    held: dict[int, list] = {}

    def full(width: int) -> Columns:
        ids, nameless, rows = zip(*held.pop(width), strict=True)
        return Columns(np.concatenate(ids), np.concatenate(nameless), np.concatenate(rows))

    for b in batches:
        vecs = common.column(b, "vec")
        ids = common.column(b, "vec_id")
        nameless = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        ends = vecs.offsets.to_numpy()
        flat, widths = vecs.values.to_numpy(zero_copy_only=False), np.diff(ends)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            rows = flat[ends[at][:, None] + np.arange(width)[None, :]]
            held.setdefault(int(width), []).append((ids[at], nameless[at], rows))
            if sum(len(x[0]) for x in held[int(width)]) >= CANDIDATES:
                yield full(int(width))
    for width in list(held):
        yield full(width)


def _search(vecs: DataFrame, block: list, k: int) -> DataFrame:
    """(query, ...) rows: of each task, at most k + 1 candidates for each query of the block, its own row among them."""
    sent = vecs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(number, vec_id, times, np.array(vec)) for number, vec_id, times, vec in sent.value]
        floors = None
        best: list[list] = [[] for _ in queries]
        for columns in _blocks(batches):
            if floors is None:
                floors = seeds([q[3] for q in queries], k + 1)
            for i, (_, vec_id, _, vec) in enumerate(queries):
                at, scores = columns.best(vec, k + 1, floors[i])
                if not len(at):
                    continue
                same = len(vec) == columns.columns.shape[0]
                found = [(-int(s), bool(columns.nameless[a]), int(columns.ids[a]), same and not columns.nameless[a] and int(columns.ids[a]) == vec_id and bool((columns.columns[:, a] == vec).all()))
                         for a, s in zip(at, scores, strict=True)]
                best[i] = sorted([*best[i], *found], key=lambda x: x[:3])[: k + 1]
                if len(best[i]) > k:
                    kth = float(-best[i][-1][0])
                    floors[i] = max(floors[i], kth - abs(kth) * SLACK)
        rows = [(q[0], q[1], q[2], None if nameless else i, own, Decimal(-s)) for q, b in zip(queries, best, strict=True) for s, nameless, i, own in b]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.decimal128(38, 0)]
        names = ["query", "query_id", "times", "vec_id", "own", "score"]
        for lo in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 10_000], strict=True), kinds, strict=True)], names=names)

    return vecs.mapInArrow(run, _FOUND)


def search(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", scale: int = SCALE, k: int = TOP, every: int = EVERY, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id is divisible by ``every``."""
    spark = df.sparkSession
    common.bounded_batches(spark)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vec}`").cast("array<double>").alias("vec"))
    rows = rows.where("vec is not null").where(finite)
    vecs = common.stage(rows.select("vec_id", F.transform("vec", lambda x: whole_part(F.lit(float(scale)) * x)).alias("vec")), "vectors")
    asked = vecs.where(F.col("vec_id") % every == 0).groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("times"))
    found = None
    for block in _query_blocks(common.stage(asked, "queries"), queries):
        part = common.stage(_best(_search(vecs, block, k), k), "best")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found.select("query_id", "rank", "vec_id", F.expr("try_cast(score as bigint)").alias("score"))


def _query_blocks(asked: DataFrame, size: int) -> Iterator[list]:
    """Numbered queries in blocks of ``size``; the driver holds one block."""
    held, number = [], 0
    for r in asked.toLocalIterator():
        held.append((number, r.vec_id, r.times, r.vec))
        number += 1
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks without the query's own row, once for each time the query row stands in the input."""
    # Own rows come first among equals, so the first of them is the one left out, and others count as candidates.
    query = Window.partitionBy("query")
    order = query.orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("own"))
    ranked = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    ranked = ranked.withColumn("mine", F.min(F.when(F.col("own"), F.col("n"))).over(query))
    ranked = ranked.where(F.col("mine").isNull() | (F.col("n") != F.col("mine")))
    rank = F.col("n") - F.when(F.col("n") > F.col("mine"), 1).otherwise(0)
    out = ranked.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score", "times").where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).drop("copy")


ORACLE = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL),
x AS MATERIALIZED (SELECT r, vec_id, i, embedding[i] AS y FROM (SELECT r, vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM e)),
bad AS (SELECT DISTINCT r FROM x WHERE y IS NULL OR NOT isfinite(y)),
v AS MATERIALIZED (SELECT r, i, CAST(floor({SCALE} * CAST(y AS DOUBLE)) AS HUGEINT) AS y FROM x WHERE r NOT IN (SELECT r FROM bad)),
ok AS (SELECT r, vec_id FROM e WHERE r NOT IN (SELECT r FROM bad)),
q AS (SELECT r, vec_id FROM ok WHERE vec_id % {EVERY} = 0),
s AS (SELECT a.r AS q, b.r AS c, sum(a.y * b.y) AS score FROM v a JOIN q ON q.r = a.r JOIN v b ON a.i = b.i AND a.r <> b.r GROUP BY a.r, b.r),
t AS (SELECT q.vec_id AS query_id, q.r AS q, ok.vec_id, coalesce(s.score, 0) AS score FROM q JOIN ok ON ok.r <> q.r LEFT JOIN s ON s.q = q.r AND s.c = ok.r)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) AS n FROM t) WHERE n <= {TOP}
"""


@register("op13_topk_blocks", ORACLE)
def op13_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every hundredth embedding."""
    return search(read_table(spark, sf_dir, "embeddings"))
