"""Benchmark decontamination by Wu-Manber search over words.

Patterns are all windows of ``window`` consecutive words of the benchmark items
(an item of fewer words is one pattern). Blocks are word pairs: a shift table
says how far the search may jump after a block, since no pattern can end
before; a block of shift zero leads to the bucket of patterns that end in it,
whose first words and then whole words are compared. Patterns of one length
share one table.

The benchmark is a stated query set. It is read in blocks of at most
``block_words`` words (a long item is cut into overlapping parts), and each
block is broadcast and searched in one pass over the documents; passes chain in
one plan without a shuffle, so a document's findings never leave its row.

Defined cases: null and empty texts have no words and are never contaminated;
items without words match nothing; items of equal text are all reported; items
of null id mark words but are not named; repeated documents are searched each;
an empty benchmark leaves all documents clean; columns named like the outputs
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

WINDOW = 10
#: Words of the benchmark that are searched for in one pass.
BLOCK_WORDS = 100_000

OUTPUT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def words(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower()) if text else []


class WuManber:
    """Search for word sequences of one length; ``patterns``: sequence -> items that hold it."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set]):
        self.length = length
        self.block = block = min(2, length)
        self.far = length - block + 1
        self.shift: dict[bytes, dict[bytes, int]] = {}
        self.bucket: dict[tuple[bytes, bytes], list[tuple[bytes, list[bytes], set]]] = {}
        for p, items in patterns.items():
            for end in range(block - 1, length):
                table = self.shift.setdefault(p[end], {})
                before = p[end - 1] if block == 2 else b""
                table[before] = min(table.get(before, self.far), length - 1 - end)
            self.bucket.setdefault((p[-2] if block == 2 else b"", p[-1]), []).append((p[0], list(p), items))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) of every occurrence."""
        m, far, shift, bucket, pair = self.length, self.far, self.shift, self.bucket, self.block == 2
        i, n = m - 1, len(text)
        while i < n:
            table = shift.get(text[i])
            if table is None:
                i += far
                continue
            before = text[i - 1] if pair else b""
            jump = table.get(before, far)
            if jump:
                i += jump
                continue
            start = i - m + 1
            first = text[start]
            for head, pattern, items in bucket[before, text[i]]:
                if head == first and text[start : i + 1] == pattern:
                    yield start, items
            i += 1


def searchers(parts: list[tuple[str | None, list[bytes]]], window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set]] = {}
    for item, w in parts:
        k = min(window, len(w))
        table = by_length.setdefault(k, {})
        for i in range(len(w) - k + 1):
            table.setdefault(tuple(w[i : i + k]), set()).add(item)
    return [WuManber(k, p) for k, p in sorted(by_length.items())]


def blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The benchmark's items as words, in blocks of bounded size."""
    held, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        w = words(row[1])
        for lo in range(0, max(1, len(w) - window + 1), block_words):
            part = w[lo : lo + block_words + window - 1]
            if part:
                held.append((row[0], part))
                size += len(part)
            if size >= block_words:
                yield held
                held, size = [], 0
    yield held


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Append n_words, spans (disjoint word ranges, both ends included, covered by occurrences) and items (sorted ids)."""
    out = common.without(docs, [f.name for f in OUTPUT])
    common.bounded_batches(docs.sparkSession)
    for k, block in enumerate(blocks(benchmark, item, item_text, window, block_words)):
        out = _search(out, text, docs.sparkSession.sparkContext.broadcast(block), window, first=k == 0)
    return out


def _search(df: DataFrame, text: str, block, window: int, first: bool) -> DataFrame:
    names = [f.name for f in OUTPUT]
    schema = T.StructType([*df.schema.fields, *(OUTPUT if first else [])])
    kinds = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = searchers(block.value, window)
        for b in batches:
            counts, spans, items = [], [], []
            before = [common.column(b, n).to_pylist() for n in names[1:]] if not first else None
            for row, t in enumerate(common.column(b, text).to_pylist()):
                w = words(t)
                hits = [(s["first"], s["last"]) for s in before[0][row]] if before else []
                named = set(before[1][row]) if before else set()
                for table in tables:
                    for start, found in table.search(w):
                        hits.append((start, start + table.length - 1))
                        named |= found
                counts.append(len(w))
                spans.append(joined(hits))
                items.append(sorted(x for x in named if x is not None))
            new = [pa.array(v, k) for v, k in zip((counts, spans, items), kinds, strict=True)]
            kept = [c for c, n in zip(b.columns, b.schema.names, strict=True) if first or n not in names]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=schema.names)

    return df.mapInArrow(run, schema)


def joined(hits: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Disjoint ranges that cover the same words."""
    out: list[dict[str, int]] = []
    for first, last in sorted(hits):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def hit_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


#: The words of a text column, for the SQL check.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS k, array_to_string(list_slice(w, i, i + least({WINDOW}, len(w)) - 1), ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN ks WHERE len(w) >= k)),
m AS (SELECT dw.doc_id, dw.k, dw.i, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""


@register("op5_decontaminate", ORACLE)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in all documents: 10-word windows."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
