"""Language-model scoring by cross-entropy difference.

Two bigram models, of the target documents and of all documents (background),
are matched: same words, same vocabulary (every word of the whole corpus, or the
``size`` most frequent ones, all others one unknown word), same order, same smoothing

    p(w | v) = (c(v, w) + mass * p(w)) / (c(v) + mass),  p(w) = (c(w) + 1) / (tokens + words)

A document's loss is the mean of -log p over its tokens (the first follows a
start mark); its score is target loss less background loss: the lower, the more
it is like the target.

Counts cover every document, and the model is never whole in one place; only the
counts of the most frequent words (a fixed number, ``WORDS``) are broadcast. Any
other word is known by a 64-bit hash, and all that its counts are needed for
goes to its own bucket: the pairs it ends (which add up to its count), the pairs
with a frequent word it begins, and how often it is a context. So -log p is sent
in two terms, log(c(v) + mass) apart where v or w is such a word. One pass
counts words. A second pass turns documents into (pair, document, count)
entries, packed in blocks for hash buckets of pairs: the pair counts of all
blocks first, then the entries. A bucket's task adds up the counts, scores the
entries block by block as they stream in, and sends each chunk of documents its
partial sums; these are added up for each chunk. A pair that is in every
document costs its bucket one entry a document, streamed, never gathered.

Defined cases: null and empty texts have no tokens and null losses and scores;
null keys are scored and are not in the target; repeated rows count and are
scored each; with no target documents the target model is uniform over words;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.operators.stats import kth_smallest
from roadframe.session import read_table

#: Words whose counts are broadcast; the ids 0 and WORDS + 1 are the unknown word and the start mark (16 bits in all).
WORDS = 65_534
START = WORDS + 1
#: Ids of rarer words are hashes from here on. With such a word, a frequent v is told by its id, a frequent w by
#: FOLLOWS + its id, the word's use as a context by CONTEXT.
RARE, FOLLOWS = 1 << 63, START + 1
CONTEXT = FOLLOWS + START
MASS = 50.0
#: Tokens and documents of a chunk, entries of a block, Arrow rows of a batch, tokens for which there is a bucket.
CHUNK_TOKENS, CHUNK_DOCS, BLOCK_ENTRIES, BATCH_ROWS, BUCKET_TOKENS = 2_000_000, 65_000, 16_384, 250, 8_000_000
#: Distinct words that a task counts before it passes its counts on.
COUNTED_WORDS = 500_000
#: Target ids up to which they are broadcast (8 bytes each).
BROADCAST_IDS = 4_000_000
COUNTS, ENTRIES, DOCS = 0, 1, 2


def words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers (in as few bytes as their largest value needs) or floats, compressed."""
    parts = []
    for a in arrays:
        if a.dtype.kind != "f":
            top = int(a.max()) if len(a) else 0
            a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
        parts += [struct.pack("<2sI", a.dtype.str[1:].encode(), len(a)), a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<2sI", raw, at)
        out.append(np.frombuffer(raw, f"<{kind.decode()}", n, at + 6))
        at += 6 + out[-1].nbytes
    return out


def rare_id(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") | RARE


class Vocabulary(dict):
    """word -> id; other words are 0. ``rare``: sorted ids of the rarer words in the vocabulary, None for all."""

    def __init__(self, ids: dict[str, int], rare: np.ndarray | None):
        super().__init__(ids)
        self.ids, self.rare = ids, rare

    def __missing__(self, word: str) -> int:
        if self.rare is not None:
            if not len(self.rare):
                return 0
            at = int(np.searchsorted(self.rare, np.uint64(i := rare_id(word))))
            i = i if at < len(self.rare) and int(self.rare[at]) == i else 0
        else:
            i = rare_id(word)
        if len(self) >= len(self.ids) + COUNTED_WORDS:
            self.clear()
            self.update(self.ids)
        self[word] = i
        return i


@dataclass
class Words:
    """The vocabulary, and for both corpora (0 target, 1 background) log-free p(w) and how often each frequent word is a context, and what p(w) is divided by."""

    ids: dict[str, int]
    rare: np.ndarray | None
    single: np.ndarray
    context: np.ndarray
    whole: np.ndarray


def with_target(docs: DataFrame, target: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, target): whether each document's key is in ``target`` (one column)."""
    ids = target.select(F.col(target.columns[0]).cast("long").alias("__llm_id")).where("__llm_id IS NOT NULL").distinct()
    few = ids.count() <= BROADCAST_IDS
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(ids) if few else ids, F.col("id") == F.col("__llm_id"), "left")
    rows = rows.select("id", "text", F.col("__llm_id").isNotNull().alias("target"))
    # chunks are cut in row order, which a repeated task must find again: a scan keeps it, a shuffle needs a sort
    return rows if few else rows.sortWithinPartitions("id", "text")


def count_words(rows: DataFrame) -> DataFrame:
    """word, and how often it stands (n) and ends a document (e) in target (t) and background (b) documents."""
    names = ["word", "nt", "nb", "et", "eb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, e = (Counter(), Counter()), (Counter(), Counter())

        def out() -> Iterator[pa.RecordBatch]:
            found = list(n[1])
            for lo in range(0, len(found), 20_000):
                part = found[lo : lo + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array([c[w] for w in part], pa.int64()) for c in (*n, *e))], names=names)
            for c in (*n, *e):
                c.clear()

        for b in batches:
            for t, is_target in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if w := words(t):
                    for k in (0, 1) if is_target else (1,):
                        n[k].update(w)
                        e[k][w[-1]] += 1
            if len(n[1]) > COUNTED_WORDS:
                yield from out()
        yield from out()

    counted = rows.mapInArrow(run, "word string, nt long, nb long, et long, eb long")
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])


def most(counted: DataFrame, n: int, size: int) -> Column:
    """Whether a word is among the ``size`` < ``n`` most frequent ones (of equal ones, the first)."""
    cut = kth_smallest(counted, "nb", [n - size])[None, n - size]  # exact: a sorted limit would send that many words from every task
    left = size - counted.where(F.col("nb") > cut).count()
    last = counted.where(F.col("nb") == cut).orderBy("word").limit(left).agg(F.max("word")).first()[0]
    return (F.col("nb") > cut) | (F.col("nb") == cut) & (F.col("word") <= last)


def vocabulary(counted: DataFrame, size: int | None = None) -> tuple[Words, int, int]:
    """The ``size`` most frequent words (None: all), and the numbers of tokens and of tokens that are in it but not frequent."""
    total = [x or 0 for x in counted.agg(*[F.sum(c) for c in ("nt", "nb", "et", "eb")]).first()]
    n = counted.count()
    size = n if size is None else min(n, size)
    frequent = min(size, WORDS)
    known_words = most(counted, n, frequent) if 0 < frequent < n else F.lit(frequent > 0)
    top = counted.where(known_words).collect()
    top.sort(key=lambda r: (-r.nb, r.word))
    known = np.array([tuple(r)[1:] for r in top], float).reshape(-1, 4)
    if size == n:
        rare, others = None if n > frequent else np.zeros(0, np.uint64), [total[k] - int(known[:, k].sum()) for k in (0, 1)]
    elif size > frequent:  # as many ids as the caller asks for
        found = counted.where(most(counted, n, size) & ~known_words)
        others = list(found.agg(F.sum("nt"), F.sum("nb")).first())
        rare = np.sort(np.fromiter((rare_id(r.word) for r in found.select("word").toLocalIterator()), np.uint64))
    else:
        rare, others = np.zeros(0, np.uint64), [0, 0]
    n, e = np.zeros((2, START + 1)), np.zeros((2, START + 1))  # of each id
    for k in (0, 1):
        n[k, 1 : len(top) + 1], e[k, 1 : len(top) + 1] = known[:, k], known[:, k + 2]
        n[k, 0] = total[k] - known[:, k].sum() - others[k]
    whole = np.array(total[:2], float) + size + 1
    single = (n + 1) / whole[:, None]
    context = n - e
    # with rarer words in the vocabulary, how often the unknown word ends a document has to leave theirs out
    ends = np.array(total[2:], float) - known[:, 2:].sum(axis=0)
    if size > frequent:
        ends = ends * 0 if rare is None else ends - np.array(found.agg(F.sum("et"), F.sum("eb")).first(), float)
    context[:, 0] -= ends
    context[:, START] = total[2], total[3]  # every document with words begins once
    return Words({r[0]: i + 1 for i, r in enumerate(top)}, rare, single, context, whole), int(total[1]), int(others[1])


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)


def _key(rare: np.ndarray, other: np.ndarray) -> np.ndarray:
    """One 64-bit number for a rarer word and what stands with it."""
    return rare * np.uint64(0x9E3779B97F4A7C15) + other * np.uint64(0xC2B2AE3D27D4EB4F)


def _grouped(what: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (what, document) once, sorted, with its count."""
    both, count = np.unique(what << np.uint64(bits) | doc, return_counts=True)
    return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64), count


BLOCKS = "bucket int, kind int, chunk long, data binary"


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["bucket", "kind", "chunk", "data"])


def entries(rows: DataFrame, vocab, buckets: int, rare_buckets: int, mass: float) -> DataFrame:
    """Packed counts and entries of each chunk of documents, for each bucket (those of rarer words come last), and the chunk's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(vocab.value.ids, vocab.value.rare)
        contexts = np.log(vocab.value.context + mass)
        first, chunk = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        target: list[bool] = []
        parts: list[np.ndarray] = []
        tokens = 0

        def out() -> Iterator[pa.RecordBatch]:
            at = first + chunk
            lengths = np.array([len(p) for p in parts], np.int64)
            word = np.concatenate(parts)
            doc = np.repeat(np.arange(len(ids), dtype=np.uint64), lengths)
            before = np.empty_like(word)
            before[1:] = word[:-1]
            before[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
            rare_word, rare_before = word >= RARE, before >= RARE
            # a frequent word's part as the context of rarer ones is known here
            near = rare_word & ~rare_before
            base = [np.bincount(doc[near].astype(np.int64), c[before[near].astype(np.int64)], len(ids)) for c in contexts] if near.any() else []
            yield _blocks([(at % buckets, DOCS, at, pack(np.array([i is None for i in ids]).astype(np.uint8), np.array([i or 0 for i in ids], np.int64).view(np.uint64), lengths, *base))])
            if not len(word):
                return
            is_target = np.array(target, bool)
            both = ~(rare_word | rare_before)
            pair = before[both] << np.uint64(16) | word[both]
            yield from sent(at, _grouped(pair, doc[both], 32), buckets, is_target)
            if both.all():
                return
            names = np.unique(word[rare_word])  # a context is a word, too
            code = lambda x: np.searchsorted(names, x).astype(np.uint64)
            beyond = np.uint64(CONTEXT + 1)
            only = rare_before & ~rare_word
            name = np.concatenate([code(word[rare_word]), code(before[only]), code(before[rare_before])])
            other = before[rare_word]
            far = other >= RARE
            other[far] = beyond + code(other[far])
            other = np.concatenate([other, word[only] + np.uint64(FOLLOWS), np.full(rare_before.sum(), CONTEXT, np.uint64)])
            where = np.concatenate([doc[rare_word], doc[only], doc[rare_before]])
            width = (CONTEXT + 1 + len(names)).bit_length()  # with the documents' at most 62 bits, as a chunk of many documents is bounded
            found, d, count = _grouped(name << np.uint64(width) | other, where, (len(ids) - 1).bit_length())
            name, other = names[(found >> np.uint64(width)).astype(np.int64)], found & np.uint64((1 << width) - 1)
            for some in (other < beyond, other >= beyond):  # short and long ids
                o = other[some]
                if len(o) and o[0] >= beyond:
                    o = names[(o - beyond).astype(np.int64)]
                yield from sent(at, (name[some], d[some], count[some]), rare_buckets, is_target, o)

        def sent(at: int, grouped: tuple, n: int, is_target: np.ndarray, other: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
            pair, doc, count = grouped
            if not len(pair):
                return
            bucket = _bucket(pair, n).astype(np.int32)
            order = np.argsort(bucket, kind="stable")  # pairs stay sorted within a bucket
            bucket, pair, doc, count = bucket[order], pair[order], doc[order], count[order]
            other = None if other is None else other[order]
            edges = np.searchsorted(bucket, np.arange(n + 1))
            held = []
            for k in range(n):
                for lo in range(edges[k], edges[k + 1], BLOCK_ENTRIES):
                    hi = min(lo + BLOCK_ENTRIES, edges[k + 1])
                    p, d, c = pair[lo:hi], doc[lo:hi], count[lo:hi]
                    new, others = p[1:] != p[:-1], []
                    if other is not None:
                        new |= other[lo + 1 : hi] != other[lo : hi - 1]
                    start = np.flatnonzero(np.append(True, new))
                    unique = p[start]
                    steps = np.diff(unique, prepend=np.uint64(0))
                    if other is not None:
                        others = [other[lo:hi][start]]
                    to = k if other is None else buckets + k
                    held.append((to, COUNTS, at, pack(steps, *others, np.add.reduceat(np.where(is_target[d], c, 0), start), np.add.reduceat(c, start))))
                    held.append((to, ENTRIES, at, pack(steps, *others, np.diff(np.append(start, len(p))), d, c)))
                    if len(held) >= BATCH_ROWS:
                        yield _blocks(held)
                        held = []
            if held:
                yield _blocks(held)

        for b in batches:
            for i, t, is_target in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = words(t)
                if ids and (tokens + len(w) > CHUNK_TOKENS or len(ids) >= CHUNK_DOCS):
                    yield from out()
                    chunk, tokens = chunk + 1, 0
                    for x in (ids, target, parts):
                        x.clear()
                ids.append(i)
                target.append(is_target)
                parts.append(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)))
                tokens += len(w)
        if ids:
            yield from out()

    return rows.select("id", "text", "target").mapInArrow(run, BLOCKS)


def partial_sums(blocks: DataFrame, vocab, buckets: int, mass: float) -> DataFrame:
    """Blocks sorted by bucket and kind -> each chunk's documents, and its sums of -log p over a bucket's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, context, whole = vocab.value.single, vocab.value.context, vocab.value.whole
        now = None
        counts: list[tuple] = []
        waiting = 0
        pairs = losses = None
        chunk, sums = None, np.zeros((2, 0))

        def merged() -> tuple:
            """Distinct pairs, their counts, and for rarer words (word, other)."""
            pair, n, *named = (np.concatenate([c[i] for c in counts], axis=-1) for i in range(len(counts[0])))
            order = np.argsort(pair, kind="stable")
            pair, n = pair[order], n[:, order]
            start = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            return pair[start], np.add.reduceat(n, start, axis=1), *(x[order][start] for x in named)

        def rare_losses(n: np.ndarray, name: np.ndarray, other: np.ndarray) -> np.ndarray:
            """-log(c(v, w) + mass * p(w)) of each pair, and log(c(v) + mass) of each context."""
            ends = (other < FOLLOWS) | (other >= RARE)
            follows = np.where(ends | (other == CONTEXT), 0, other - np.uint64(FOLLOWS)).astype(np.int64)
            _, of = np.unique(name, return_inverse=True)
            out = np.empty(n.shape)
            for k in (0, 1):
                times = np.bincount(of, np.where(ends, n[k], 0))[of]
                out[k] = np.where(other == CONTEXT, np.log(n[k] + mass), -np.log(n[k] + mass * np.where(ends, (times + 1) / whole[k], single[k, follows])))
            return out

        def sent() -> Iterator[pa.RecordBatch]:
            if chunk is not None and (some := np.flatnonzero(sums[1])).size:
                yield _blocks([(now, ENTRIES, chunk, pack(some, *sums[:, some].astype("<f4")))])

        for b in batches:
            for bucket, kind, at, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == DOCS:
                    yield _blocks([(bucket, DOCS, at, data)])
                    continue
                if bucket != now:
                    yield from sent()
                    now, counts, waiting, pairs, chunk = bucket, [], 0, None, None
                arrays = unpack(data)
                pair = np.cumsum(arrays[0].astype(np.uint64), dtype=np.uint64)
                named = []
                if bucket >= buckets:
                    named = [pair, arrays.pop(1).astype(np.uint64)]
                    pair = _key(*named)
                if kind == COUNTS:
                    counts.append((pair, np.stack([a.astype(np.int64) for a in arrays[1:]]), *named))
                    waiting += len(pair)
                    if waiting > 4_000_000:
                        counts = [merged()]
                        waiting = len(counts[0][0]) - 4_000_000 if len(counts[0][0]) > 4_000_000 else 0
                    continue
                if pairs is None:
                    pairs, n, *rest = merged()
                    if rest:
                        losses = rare_losses(n, *rest)
                    else:
                        v, w = (pairs >> np.uint64(16)).astype(np.int64), (pairs & np.uint64(0xFFFF)).astype(np.int64)
                        losses = -np.log((n + mass * single[:, w]) / (context[:, v] + mass))
                    counts = []
                if at != chunk:
                    yield from sent()
                    chunk, sums = at, np.zeros((2, CHUNK_DOCS))
                where = np.repeat(np.searchsorted(pairs, pair), arrays[1])
                for k in (0, 1):
                    sums[k] += np.bincount(arrays[2], losses[k][where] * arrays[3], CHUNK_DOCS)
        yield from sent()

    return blocks.repartition("bucket").sortWithinPartitions("bucket", "kind", "chunk").mapInArrow(run, BLOCKS)


SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def totals(sums: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, lengths, total = None, None, None, None

        def out() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            some = lengths > 0
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = total[:, : len(lengths)] / lengths
            columns = [ids, pa.array(lengths), *(pa.array(x, mask=~some) for x in (mean[0], mean[1], mean[0] - mean[1]))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCORES.split(", ")])

        for b in batches:
            for at, kind, data in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                arrays = unpack(data)
                if kind == DOCS:  # a chunk's first row
                    yield from out()
                    now, total = at, np.zeros((2, CHUNK_DOCS))
                    if arrays[3:]:
                        total[:, : len(arrays[2])] = np.stack(arrays[3:])
                    ids, lengths = pa.array(arrays[1].astype(np.uint64).view(np.int64), mask=arrays[0].astype(bool)), arrays[2].astype(np.int64)
                else:
                    total[:, arrays[0]] += np.stack(arrays[1:])
        yield from out()

    return sums.repartition("chunk").sortWithinPartitions("chunk", F.desc("kind"), "bucket").mapInArrow(run, SCORES)


def score(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", size: int | None = None, mass: float = MASS) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every document; ``target``: keys of the target documents, ``size``: words of the vocabulary, None for all."""
    spark = docs.sparkSession
    common.bounded_batches(spark, BATCH_ROWS)
    rows = with_target(docs, target, key, text)
    vocab, tokens, rare = vocabulary(common.stage(count_words(rows), "word-counts"), size)
    shared = spark.sparkContext.broadcast(vocab)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, rare_buckets = max(least, -(-tokens // BUCKET_TOKENS)), max(least, -(-3 * rare // BUCKET_TOKENS))
    return totals(partial_sums(entries(rows, shared, buckets, rare_buckets, mass), shared, buckets, mass))


@register("op1_lm_score")
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against those labelled good."""
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score(read_table(spark, sf_dir, "documents"), good)
