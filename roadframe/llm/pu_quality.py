"""Quality classifier by positive-unlabelled learning.

Trusted positives P are documents labelled good; unlabelled text U is all
documents that may be learnt from, labels unseen. With class prior pi and the
logistic loss l, the model (linear in piecewise-linear features) minimises the
non-negative unbiased risk

    pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])  (+ a small ridge)

Newton steps follow the unbiased risk; the step length is searched on the
non-negative risk, and steps that would make the second part negative are cut
back, so the fit can't profit from it. Documents labelled bad are never used as
such.

The prior is estimated from P and U alone: a first model tells P from U; the
share of U above a cutoff divided by the share of P above it is an upper bound
of the prior that is tight where only positives are left, and the cutoff is the
one of least confidence bound.

All of P and U take part. Each pass over the features sums gradients and
curvature in Spark; the driver gets as many numbers as the model has parameters
squared, at any input size. A fit takes about twenty passes.

Defined cases: null and empty texts have all-zero statistics and get a score
like others; rows with a null id are scored and count as unlabelled; repeated
rows are scored each; ids with contradictory labels are not positives; without
positives or without documents every score is the prior's default 0.5; columns
named like the outputs are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

#: Ridge weight: a constant part and one that falls with the number of trusted positives.
RIDGE, RIDGE_ROWS = 1e-2, 10.0
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.0)
MOST_ROUNDS = 12
THRESHOLD = 0.3
SCORE_BINS = 1000
CONFIDENCE = 0.1

#: Statistic -> knots of its piecewise-linear features.
KNOTS = {
    "log_words": (2, 3, 4, 5, 6, 7),
    "symbols": (0.01, 0.05, 0.1, 0.2),
    "dup_lines": (0.05, 0.2, 0.4, 0.6),
    "distinct": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "word_bytes": (3, 4, 4.5, 5, 5.5, 6, 7),
    "capitals": (0.02, 0.05, 0.1, 0.2, 0.4),
    "digits": (0.01, 0.05, 0.1),
    "stops": (0.02, 0.05, 0.1, 0.2, 0.3),
    "bare_marks": (0.05, 0.2, 0.4),
    "top_word": (0.05, 0.1, 0.2, 0.4),
    "echoes": (0.01, 0.05, 0.2, 0.5),
    "shouts": (0.01, 0.05, 0.2),
    "short_words": (0.1, 0.2, 0.3, 0.4, 0.5),
    "log_line_words": (1, 2, 3, 4, 5),
    "other_marks": (0.02, 0.05, 0.1, 0.2),
}
N_STATS = len(KNOTS)
_CLASSES = {"symbols": b"#*$%&|<>", "capitals": bytes(range(65, 91)), "digits": bytes(range(48, 58)), "stops": b".,", "shouts": b"!?"}
_PLAIN = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + b" \t\n\r\x0b\x0c" + bytes(range(128, 256))


def statistics(text: str | None) -> list[float]:
    """The statistics in the order of ``KNOTS``, over the whole text."""
    data = (text or "").encode()
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * N_STATS
    chars = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    of = {k: int(chars[list(v)].sum()) for k, v in _CLASSES.items()}
    lines = [x for x in data.split(b"\n") if x.strip()]
    counts = Counter(words)
    lengths = list(map(len, words))
    return [
        float(np.log1p(n)), of["symbols"] / size, 1 - len(set(lines)) / len(lines), len(counts) / n, sum(lengths) / n, of["capitals"] / size, of["digits"] / size,
        of["stops"] / n, sum(counts[m] for m in (b"|", b"-", b"*", b"#", b"/", b"=")) / n, max(counts.values()) / n, sum(map(eq, words, words[1:])) / n,
        of["shouts"] / n, sum(map((4).__gt__, lengths)) / n, float(np.log1p(n / len(lines))), (size - int(chars[list(_PLAIN)].sum())) / size,
    ]


def expand(stats: np.ndarray) -> np.ndarray:
    """Piecewise-linear features of the statistics: each, and its excess over each knot."""
    parts = []
    for i, knots in enumerate(KNOTS.values()):
        x = stats[:, i : i + 1]
        parts += [x, np.maximum(x - np.array(knots, float), 0)]
    return np.concatenate(parts, axis=1)


WIDTH = expand(np.zeros((1, N_STATS))).shape[1]


@dataclass
class Model:
    """score = sigmoid((features - mean) / scale @ weights + bias)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the bias
    prior: float

    def inputs(self, stats: np.ndarray) -> np.ndarray:
        x = (expand(stats) - self.mean) / self.scale
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(stats) @ self.weights, -30, 30)))


STATS = "__llm_stats"


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the packed statistics of each whole text."""

    def make():
        return lambda b: [pa.array([np.array(statistics(t), "<f8").tobytes() for t in common.column(b, text).to_pylist()], pa.binary())]

    return common.add_columns(df, [T.StructField(STATS, T.BinaryType())], make)


def unpack(a: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(a.to_pylist()), "<f8").reshape(-1, N_STATS)


def _sums(rows: DataFrame, size: int, of_batch) -> np.ndarray:
    """Sum of ``of_batch(statistics, positive)`` (``size`` numbers) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        some = False
        for b in batches:
            if b.num_rows:
                some = True
                total += of_batch(unpack(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(bool))
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "v"])

    out = np.zeros(size)
    for at, v in rows.select(STATS, "positive").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v")).collect():
        out[at] = v
    return out


def _soft(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _newton(rows: DataFrame, start: Model, n_p: float, n_u: float, pu: bool) -> Model:
    """Minimise the non-negative PU risk (``pu``) or the log loss of telling P from U, both classes weighted alike."""
    d, w, pi, weight = WIDTH + 1, start.weights.copy(), start.prior, RIDGE + RIDGE_ROWS / n_p
    m = Model(start.mean, start.scale, w, pi)

    def slopes(stats: np.ndarray, positive: np.ndarray) -> np.ndarray:
        x = m.inputs(stats)
        s = 1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30)))
        p = x[positive]
        if pu:
            grad = (x * s[:, None]).sum(0) / n_u - pi * p.sum(0) / n_p
            curve = (x * (s * (1 - s))[:, None]).T @ x / n_u
        else:
            sp = s[positive]
            grad = (x * s[:, None]).sum(0) / n_u - (p * (1 - sp)[:, None]).sum(0) / n_p
            curve = (x * (s * (1 - s))[:, None]).T @ x / n_u + (p * (sp * (1 - sp))[:, None]).T @ p / n_p
        return np.concatenate([grad, curve.ravel()])

    def risks(candidates: list[np.ndarray]) -> np.ndarray:
        def of_batch(stats: np.ndarray, positive: np.ndarray) -> np.ndarray:
            f = m.inputs(stats) @ np.stack(candidates, axis=1)
            return np.concatenate([_soft(-f[positive]).sum(0) / n_p, _soft(f[positive]).sum(0) / n_p, _soft(f).sum(0) / n_u])

        r = _sums(rows, 3 * len(candidates), of_batch).reshape(3, -1)
        ridge = np.array([weight / 2 * (c[:-1] ** 2).sum() for c in candidates])
        return pi * r[0] + np.maximum(0, r[2] - pi * r[1]) + ridge + 1e3 * np.maximum(0, pi * r[1] - r[2]) if pu else r[0] + r[2] + ridge

    shrink = np.append(np.full(d - 1, weight), 1e-9)
    before = np.inf
    for _ in range(MOST_ROUNDS):
        s = _sums(rows, d + d * d, slopes)
        step = np.linalg.solve(s[d:].reshape(d, d) + np.diag(shrink + 1e-9), s[:d] + shrink * m.weights)
        tries = [m.weights - t * step for t in STEPS]
        risk = risks(tries)
        k = int(np.argmin(risk))
        m.weights = tries[k]
        if STEPS[k] == 0 or before - risk[k] < 1e-5:
            break
        before = risk[k]
    return m


def estimate_prior(rows: DataFrame, contrast: Model, n_p: float, n_u: float) -> float:
    """Share of positives in U: least confidence bound of (share of U) / (share of P) above a score."""

    def bins(stats: np.ndarray, positive: np.ndarray) -> np.ndarray:
        k = np.minimum((contrast.score(stats) * SCORE_BINS).astype(int), SCORE_BINS - 1)
        return np.concatenate([np.bincount(k[positive], minlength=SCORE_BINS), np.bincount(k, minlength=SCORE_BINS)]).astype(float)

    h = _sums(rows, 2 * SCORE_BINS, bins).reshape(2, SCORE_BINS)[:, ::-1].cumsum(axis=1)
    share_p, share_u = h[0] / n_p, h[1] / n_u
    slack = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (n_p**-0.5 + n_u**-0.5)
    seen = share_p > slack
    ratio = share_u[seen] / share_p[seen]
    best = int(np.argmin(ratio + slack / share_p[seen])) if seen.any() else None
    return float(np.clip(ratio[best], 0.02, 0.98)) if best is not None else 0.5


def fit(rows: DataFrame) -> Model:
    """rows: packed statistics and ``positive``; every row is also an unlabelled one."""
    moments = _sums(rows, 2 * WIDTH + 2, lambda s, p: np.concatenate([(x := expand(s)).sum(0), (x * x).sum(0), [len(x), p.sum()]]))
    n_u, n_p = moments[-2:]
    if not n_u or not n_p:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), 0.5)
    mean = moments[:WIDTH] / n_u
    scale = np.sqrt(np.maximum(moments[WIDTH : 2 * WIDTH] / n_u - mean**2, 0))
    start = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(WIDTH + 1), 0.5)
    half = [rows.where(F.pmod(F.xxhash64(STATS), F.lit(2)) == k) for k in (0, 1)]  # the prior is read off rows that the contrast has not seen
    sizes = [[float(x) for x in h.agg(F.count_if("positive"), F.count(F.lit(1))).first()] for h in half]
    if min(sizes[0] + sizes[1]) > 0:
        start.prior = estimate_prior(half[1], _newton(half[0], start, *sizes[0], pu=False), *sizes[1])
    return _newton(rows, start, n_p, n_u, pu=True)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trusted(labels: DataFrame) -> DataFrame:
    """Ids with good labels only, of rows that may be learnt from."""
    return labels.where(~held_out("doc_id")).groupBy(F.col("doc_id").alias("__llm_id")).agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = 1 AND high = 1").select("__llm_id", F.lit(True).alias("positive"))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, positive, packed statistics) of every document, in the shared folder."""
    narrow = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = with_statistics(narrow).select("id", STATS, held_out("id").alias("held_out")).join(trusted(labels), F.col("id") == F.col("__llm_id"), "left")
    return common.stage(rows.select("id", "held_out", F.coalesce("positive", F.lit(False)).alias("positive"), STATS), "quality-statistics")


def score(df: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Replace the packed statistics by the score."""

    def make():
        return lambda b: [pa.array(model.score(unpack(common.column(b, STATS))), pa.float64())]

    return common.add_columns(df, [T.StructField(out, T.DoubleType())], make).drop(STATS)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on ``docs`` and ``labels``, and append ``score`` to every row of ``docs``.

    Statistics and score are one Python pass: with two, each task would hold two workers, and idle ones are kept for later stages.
    """
    model = fit(training_rows(docs, labels, key, text).where("NOT held_out"))

    def make():
        return lambda b: [pa.array(model.score(np.array([statistics(t) for t in common.column(b, text).to_pylist()])), pa.float64())]

    return common.add_columns(docs, [T.StructField("score", T.DoubleType())], make).drop(STATS)


@register("op3_pu_quality")
def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = training_rows(docs, read_table(spark, sf_dir, "labels"))
    scored = score(rows, fit(rows.where("NOT held_out")))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
