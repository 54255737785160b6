"""SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints: XXH64 (seed 42) of every word shingle, repeats included; a bit is
set if it is set in over half the hashes.

Search: the 64 bits are split into m groups, correlated bits together. Group i
gets a threshold t_i >= -1 with sum(t_i + 1) = max_bits + 1, so two
fingerprints within ``max_bits`` differ in at most t_i bits of some group i
(t_i = -1: the group is not probed). Thresholds are unequal: for each m, dynamic
programming finds those of least estimated cost, from candidate counts that
follow from the bit frequencies over all fingerprints; the cheapest m wins, so
the split adapts to the number of fingerprints. Probes: within a group of w
bits and threshold t, each fingerprint gives C(w, t) signatures, one for each
set of t ignored bits. Fingerprints that share a signature are candidates, and
their Hamming distance is checked.

Equal fingerprints are one node. A signature's fingerprints are compared
within one bounded block, or, beyond ``BLOCK`` of them, in pairs of blocks
dealt to separate groups. A block gives only the links that connect what is
not yet connected in it, so dense groups don't emit all pairs and no link
between components is lost.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; null ids belong to their group but never name it (a group of null ids
has a null component id); repeated rows are members like others; an empty table
gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.llm import common
from roadframe.llm.components import components
from roadframe.llm.registry import register
from roadframe.session import read_table

SEED = 42
#: Fingerprints of one signature that are compared in one group.
BLOCK = 8192
#: Cost of making, moving and sorting one signature, in checks of one candidate pair.
SIGNATURE_COST = 60
#: Most signatures that a fingerprint may give in one group.
MOST_SIGNATURES = 300
_LOW_BITS = np.uint64(0x0101010101010101)


def fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text (unsigned)."""
    digest = xxhash.xxh64_digest
    hashes: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        words = t.encode().lower().split() if t else []  # bytes: A-Z and ASCII white space only
        if not words:
            continue
        joined = b" ".join(words)
        n = max(1, len(words) - shingle + 1)
        if n == 1:
            hashes.append(digest(joined, SEED))
        else:
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size + 1) - 1
            hashes += [digest(joined[a:z], SEED) for a, z in zip((end - size)[:n].tolist(), end[shingle - 1 :].tolist(), strict=True)]
        counts[k] = n
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    h = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64)
    first = np.cumsum(counts[full]) - counts[full]
    parts = -(-counts[full] // 255)  # at most 255 hashes add up in one byte
    part_first = np.cumsum(parts) - parts
    starts = np.repeat(first, parts) + 255 * (np.arange(parts.sum()) - np.repeat(part_first, parts))
    ones = np.zeros((len(full), 64), np.int64)
    for bit in range(8):
        sums = np.add.reduceat((h >> np.uint64(bit)) & _LOW_BITS, starts)
        ones[:, bit::8] = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), part_first, axis=0)
    out[full] = ((2 * ones > counts[full][:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprints(df: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long."""
    common.bounded_batches(df.sparkSession)
    base = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1).to_pylist(), shingle).view(np.int64))], names=["id", "fp"])

    return base.mapInArrow(run, T.StructType([T.StructField("id", base.schema["id"].dataType), T.StructField("fp", T.LongType())]))


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each two bits are set together (64 x 64), over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64), np.int64), 0
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = ((fp[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(fp)
        if n:
            at = np.arange(64 * 64 + 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n))], names=["at", "n"])

    both = np.zeros(64 * 64 + 1, np.int64)
    for at, n in fps.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():  # 4097 rows
        both[at] = n
    return int(both[-1]), both[:-1].reshape(64, 64)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """Split the bits into m groups of nearly equal size, each grown by the bit that correlates most with it."""
    p = np.diag(together) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(1, n) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for k in range(m):
        width = 64 // m + (k < 64 % m)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < width:
            b = max(sorted(left), key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            left.discard(b)
        groups.append(sorted(group))
    return groups


def within(n: int, together: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Estimated number of pairs that differ in at most t = 0..most bits of the group, from the bits' frequencies."""
    p = np.diag(together)[group] / max(1, n)
    chance = np.zeros(most + 1)
    chance[0] = 1
    for q in 2 * p * (1 - p):
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return np.cumsum(chance) * n * (n - 1) / 2


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with sum(t + 1) = budget; costs[i][t + 1] is the cost of threshold t in group i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        now: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for step, more in enumerate(cost):
                if used + step <= budget and (used + step not in now or c + more < now[used + step][0]):
                    now[used + step] = (c + more, [*ts, step - 1])
        best = now
    return best.get(budget, (math.inf, []))


def plan(n: int, together: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """Bit groups and their thresholds (only those that are probed)."""
    best = (math.inf, [])
    for m in range(1, max_bits + 2):
        groups = group_bits(n, together, m)
        costs = []
        for g in groups:
            pairs = within(n, together, g, max_bits)
            costs.append([0.0, *(n * SIGNATURE_COST * math.comb(len(g), t) + pairs[t] if math.comb(len(g), t) <= MOST_SIGNATURES else math.inf for t in range(max_bits + 1))])
        cost, ts = allocate(costs, max_bits + 1)
        if cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0])
    return best[1]


def signature_masks(groups: list[tuple[list[int], int]]) -> np.ndarray:
    """One mask for each group and set of ignored bits."""
    out = []
    for g, t in groups:
        whole = sum(1 << b for b in g)
        out += [whole - sum(1 << b for b in s) for s in combinations(g, t)]
    return np.array(out, np.uint64)


def connect(group: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Index pairs within max_bits and in one group (sorted) that together connect all such pairs."""
    n = len(fp)
    label = np.arange(n)
    found: list[tuple[int, int]] = []
    at, d = np.arange(n - 1), 0
    while len(at):
        d += 1
        at = at[at + d < n]
        at = at[group[at] == group[at + d]]
        new = at[label[at] != label[at + d]]
        near = new[np.bitwise_count(fp[new] ^ fp[new + d]) <= max_bits]
        if len(near):
            for i, j in zip(near.tolist(), (near + d).tolist(), strict=True):
                a, b = label[i], label[j]
                while label[a] != a:
                    a = label[a]
                while label[b] != b:
                    b = label[b]
                if a != b:
                    label[max(a, b)] = min(a, b)
                    found.append((i, j))
            while not np.array_equal(label, deeper := label[label]):
                label = deeper
    return np.array(found, np.int64).reshape(-1, 2)


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect all fingerprints within ``max_bits``."""
    n, together = bit_counts(fps)
    masks = signature_masks(plan(n, together, max_bits))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = (fp[None, :] & masks[:, None]).ravel()
            codes = np.repeat(np.arange(len(masks), dtype=np.int32), len(fp))
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(keys.view(np.int64)), pa.array(np.tile(fp, len(masks)).view(np.int64))], names=["code", "key", "fp"])

    probes = fps.mapInArrow(probe, "code int, key long, fp long")
    large = common.stage(probes.groupBy("code", "key").count().where(F.col("count") > BLOCK), "large-signatures")
    keys = ["code", "key"]
    if large.take(1):
        blocks = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int")
        probes = probes.join(large, keys, "left").select(*keys, "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("own"))
        probes = probes.select(*keys, "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        probes = probes.select(*keys, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
        keys = [*keys, "lo", "hi"]
    probes = probes.repartition(*keys).sortWithinPartitions(*keys, "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # of the last group, which the next batch may continue
        last, count = None, 0

        def linked(rows: list[np.ndarray]) -> pa.RecordBatch | None:
            rows = np.concatenate(rows) if rows else np.zeros((0, len(keys) + 1), np.int64)
            if len(rows) < 2:
                return None
            new = np.append(True, (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1))
            fp = rows[:, -1].view(np.uint64) if rows.flags.c_contiguous and rows.shape[1] == 1 else np.ascontiguousarray(rows[:, -1]).view(np.uint64)
            pairs = connect(np.cumsum(new), fp, max_bits)
            ends = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[pairs[:, 0]]), pa.array(ends[pairs[:, 1]])], names=["a", "b"]) if len(pairs) else None

        for b in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
            if not len(rows):
                continue
            same = (rows[:, :-1] == rows[-1, :-1]).all(axis=1)
            cut = int(len(rows) - np.argmin(same[::-1])) if not same.all() else 0  # where the last group begins
            if cut == 0 and (last is None or (last == rows[-1, :-1]).all()):
                held.append(rows)
            else:
                if (out := linked([*held, rows[:cut]])) is not None:
                    yield out
                held = [rows[cut:]]
            last = rows[-1, :-1]
        if (out := linked(held)) is not None:
            yield out

    return probes.mapInArrow(verify, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp, component_id) for each row; component_id: smallest id reachable over fingerprints within ``max_bits``."""
    rows = common.stage(with_fingerprints(df, id_col, text, shingle), "fingerprints")
    nodes = common.stage(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fingerprints")
    roots = components(links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    names = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(nodes.join(names, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without all but one of each near-duplicate group: the one of smallest id stays (null ids last).

    Rows are numbered and written once, so that the groups and the rows that leave are found on the same rows
    under the same numbers, whatever ``docs`` is (shuffled, limited, or read from files).
    """
    rows = common.stage(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "numbered-documents")
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col("__llm_row").alias("row"))
    found = near_duplicates(rows.select(key.alias("key"), F.col(text).alias("text")), "key", "text", shingle, max_bits)
    gone = common.stage(found.where(F.col("id") != F.col("component_id")).select(F.col("id.row").alias("__llm_gone")), "near-copies")
    return rows.join(gone, F.col("__llm_row") == F.col("__llm_gone"), "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


@register("op4_simhash_gph")
def op4_simhash_gph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, at most 4 bits apart."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
