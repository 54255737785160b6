"""Source divergence audit by a frequent-pattern tree of term rows.

A term's row holds its nonzero counts by source, in source order. The distance
of two sources of a language sums ``f(p, q)`` over all kept terms, most of which
one or both of them never use. So the sum is put together from

* the value of a term that neither uses, times the number of terms;
* corrections for a term that one of them uses ``n`` times: one for each
  different ``n`` of a source, times the terms that have it;
* corrections for terms that both use: the rows, with multiplicities, are
  inserted in a tree whose nodes are (source, count). Rows that begin alike share
  a path, so a node and an ancestor are worked out once, times the rows below.

Rows reach a task in path order, so a node is finished when the next row leaves
it: only the open path is held, and the tree of any number of rows is built in
bounded memory. Ranges of paths go to different tasks (a language of a third of
all terms is split like others); a path cut by a range's end is two nodes, whose
corrections add up to the same.

Counts are gathered in each task before any shuffle, in tables of at most
``HELD`` entries. All arithmetic is on integers. A row is as long as the language
has sources at most, which is what one source's part of the result has as rows.

Defined cases: every row of the input is a document, repeated rows too; null text,
language and source read as ''; a group without terms has all its pairs; a
language without kept terms has pairs of value 0 and no terms; a language of one
source has no pairs; ties go by the item's bytes; an empty table gives no rows;
only the three named columns are read, so further columns can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

MIN_DOCS, TOP = 10, 10
SCALE, ADDED = 1_000_000_000, 2
#: Entries that a task's count tables hold, rows it emits at once, and bytes of a text that are split at once.
HELD, OUT_ROWS, PIECE = 300_000, 50_000, 1 << 20
#: Pair corrections worked out at once, and held before equal pairs are added up.
CELLS, PAIRS = 1 << 18, 1 << 20
#: Entries of a path that decide its range.
KEY_ENTRIES = 16

#: A-Z become a-z, other characters below 0x80 but a-z become spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    folded, start = text.translate(_FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of the task's rows, and a row without a term for each group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for b in batches:
        langs, sources, texts = (common.column(b, c).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs, sources, texts, strict=True):
            if (group := groups.get((lang, source))) is None:
                group = groups[lang, source] = Counter(), Counter()
                held += 1
            n, docs = group
            before, seen = len(n), set()
            for words in pieces(text):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from _rows(groups)
                groups, held = {}, 0
    yield from _rows(groups)


def _rows(groups: dict) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
    held: list[list] = [[] for _ in names]

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(v, k) for v, k in zip(held, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for (lang, source), (n, docs) in groups.items():
        terms = list(n)
        held[0] += [lang] * (len(terms) + 1)
        held[1] += [source] * (len(terms) + 1)
        held[2] += [None, *terms]
        held[3] += [0, *n.values()]
        held[4] += [0, *map(docs.__getitem__, terms)]
        if len(held[0]) >= OUT_ROWS:
            yield batch()
            held = [[] for _ in names]
    if held[0]:
        yield batch()


def _p(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exact for any long count."""
    big = F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(19,0)")
    return F.call_function("div", big, (total + ADDED * terms).cast("decimal(19,0)")) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """Pair corrections of one language's rows, inserted in path order.

    The open path is held as arrays: the sources' numbers, counts, p's, p's of an unused term, and the rows that
    end at a node or in its finished children.
    """

    def __init__(self):
        self.path = np.zeros((4, 0), np.int64)
        self.rows = np.zeros(0, np.int64)
        self.keys: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.held = 0

    def insert(self, path: np.ndarray, times: int) -> None:
        k = min(path.shape[1], self.path.shape[1])
        differs = np.flatnonzero((path[:2, :k] != self.path[:2, :k]).any(axis=0))
        shared = int(differs[0]) if len(differs) else k
        self.close(shared)
        self.path = path
        self.rows = np.concatenate([self.rows[:shared], np.zeros(path.shape[1] - shared, np.int64)])
        if len(self.rows):
            self.rows[-1] += times

    def close(self, shared: int) -> None:
        """Finish the open nodes below the first ``shared``: each with its ancestors once, times its rows."""
        length = self.path.shape[1]
        if shared >= length:
            return
        rows = np.cumsum(self.rows[shared:][::-1])[::-1]
        if shared:
            self.rows[shared - 1] += rows[0]
        step = max(1, CELLS // length)
        for lo in range(max(shared, 1), length, step):
            node = np.arange(lo, min(lo + step, length))
            at, above = np.nonzero(np.arange(node[-1])[None, :] < node[:, None])
            source, _, p, z = self.path[:, node[at]]
            source_above, _, p_above, z_above = self.path[:, above]
            value = _f_of(p, p_above) - _f_of(p, z_above) - _f_of(z, p_above) + _f_of(z, z_above)
            self.keys.append(source_above << 32 | source)
            self.values.append(value * rows[node[at] - shared])
            self.held += len(at)
        if self.held > PAIRS:
            self.add_up()

    def add_up(self) -> None:
        if self.keys:
            keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
            values = np.zeros(len(keys), np.int64)
            np.add.at(values, where, np.concatenate(self.values))
            self.keys, self.values, self.held = [keys], [values], len(keys)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """What has been gathered since the last call: pairs (number above, number below) and their sums."""
        self.add_up()
        out = (self.keys[0], self.values[0]) if self.keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.keys, self.values, self.held = [], [], 0
        return out


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, lo, hi, value): sums of pair corrections, of rows (lang, path, times) in the order of lang and path."""
    tree, now, numbers, names = Tree(), None, {}, []

    def out(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(keys), OUT_ROWS):
            k, source = keys[lo : lo + OUT_ROWS], pa.array(names, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([now] * len(k), pa.string()), source.take(pa.array(k >> 32)), source.take(pa.array(k & 0xFFFFFFFF)), pa.array(values[lo : lo + OUT_ROWS])],
                names=["lang", "lo", "hi", "value"])

    def finish() -> Iterator[pa.RecordBatch]:
        tree.close(0)
        yield from out(*tree.pairs())

    for b in batches:
        langs, times, paths = common.column(b, "lang").to_pylist(), common.column(b, "times").to_numpy(), common.column(b, "path")
        ends, flat = paths.offsets.to_numpy(), paths.values
        n, p, z = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("n", "p", "z"))
        coded = pc.dictionary_encode(pc.struct_field(flat, "source"))
        own, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        start = 0
        while start < len(langs):
            if langs[start] != now:
                yield from finish()
                tree, now, numbers, names = Tree(), langs[start], {}, []
            end = next((i for i in range(start, len(langs)) if langs[i] != now), len(langs))
            for x in own:
                if x not in numbers:
                    numbers[x] = len(names)
                    names.append(x)
            number = np.array([numbers[x] for x in own], np.int64)
            cells = np.stack([number[code[ends[start] : ends[end]]], n[ends[start] : ends[end]], p[ends[start] : ends[end]], z[ends[start] : ends[end]]])
            for i in range(start, end):
                tree.insert(cells[:, ends[i] - ends[start] : ends[i + 1] - ends[start]], int(times[i]))
                if tree.held > PAIRS // 2:
                    yield from out(*tree.pairs())
            start = end
    yield from finish()


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to each other source, and the terms used more than in the language."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    read = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = read.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = common.stage(counts, "term-counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("row")).where(F.col("docs") >= min_docs)
    kept = common.stage(kept.select("lang", "term", "total", "row"), "term-rows")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all"))
    entries = kept.select("lang", "term", "total", F.inline("row"))
    used = entries.groupBy("lang", "source").agg(F.sum("n").alias("used"))
    groups = counts.where("term is null").select("lang", "source").join(used, ["lang", "source"], "left").join(langs, "lang", "left")
    own = F.coalesce("used", F.lit(0).cast("long"))
    groups = common.stage(groups.select("lang", "source", "terms", "all", own.alias("used"), _p(F.lit(0).cast("long"), own, F.col("terms")).alias("z")), "groups")

    entries = entries.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "n", "z", _p(F.col("n"), F.col("used"), F.col("terms")).alias("p"), _p(F.col("total"), F.col("all"), F.col("terms")).alias("q"))
    entries = common.stage(entries, "entries")
    return _pairs(entries, groups).unionByName(_terms(entries, top))


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    rows = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n", "p", "z"))).alias("path"))
    rows = common.stage(rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")), "paths")
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spark samples range keys on the driver, so the key is short: 4 hex digits for each of a path's first entries.
    # Paths that begin alike have keys that begin alike, whatever their hashes.
    digits = F.transform(F.slice("path", 1, KEY_ENTRIES), lambda x: F.substring(F.lpad(F.hex(F.xxhash64(x["source"], x["n"])), 16, "0"), 13, 4))
    both = rows.repartitionByRange(parts, F.col("lang"), F.array_join(digits, "")).sortWithinPartitions("lang", "path").mapInArrow(_tree, "lang string, lo string, hi string, value long")

    other = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"))
    lo, hi = F.least("source", "other").alias("lo"), F.greatest("source", "other").alias("hi")
    one = entries.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("times")).join(other, "lang").where("source <> other")
    one = one.groupBy("lang", lo, hi).agg(F.sum(F.col("times") * (_f(F.col("p"), F.col("other_z")) - _f(F.col("z"), F.col("other_z")))).alias("value"))
    none = groups.join(other, "lang").where("source < other").select(
        "lang", lo, hi, F.coalesce(F.col("terms") * _f(F.col("z"), F.col("other_z")), F.lit(0).cast("long")).alias("value"))

    sums = none.union(one).union(both).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("lo").alias("source"), F.col("hi").alias("item")), F.struct(F.col("hi").alias("source"), F.col("lo").alias("item")))
    return _ranked(sums.select("lang", "value", F.inline(ways)), "pair")


def _terms(entries: DataFrame, top: int) -> DataFrame:
    more = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    return _ranked(more, "term").where(F.col("rank") <= top)


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


#: Terms of a text column, for the SQL check.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCS}),
c AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
g AS (SELECT a.lang, a.source, coalesce(b.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) a
      LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) b ON a.lang = b.lang AND a.source = b.source),
gt AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
              1 + {SCALE}::HUGEINT * (coalesce(c.c, 0) + {ADDED}) // (g.n + {ADDED} * l.v) AS p,
              1 + {SCALE}::HUGEINT * (kept.c + {ADDED}) // (l.n + {ADDED} * l.v) AS q
       FROM g JOIN l ON g.lang = l.lang JOIN kept ON kept.lang = g.lang
       LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM gt a JOIN gt b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
allpairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
             FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
             LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM gt WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM allpairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""


@register("op11_source_divergence", ORACLE)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources of each language against each other, and the terms each uses most beyond its language."""
    return audit(read_table(spark, sf_dir, "documents"))
