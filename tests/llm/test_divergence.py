"""The source audit against plain Python, and its tree against direct sums."""

import collections
import random
import re

import numpy as np
import pytest

from roadframe.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, min_docs, top=10):
    """Every number of the contract, term by term and pair by pair."""
    docs = [(lang or "", source or "", TERM.findall(fold(text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        v, counts = len(kept), {s: collections.Counter() for s in {d[1] for d in own}}
        for _, source, terms in own:
            counts[source].update(t for t in terms if df[t] >= min_docs)
        whole = sum(counts.values(), collections.Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * v)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in counts.items():
            pairs = [(sum(f(p(c, t), p(o, t)) for t in kept), other) for other, o in counts.items() if other != s]
            terms = [(f(p(c, t), p(whole, t)), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


def test_against_plain_python(spark):
    r = random.Random(3)
    words = [f"{a}{b}" for a in "abcdé" for b in "vwxyz한"] + ["ÀB", "Straße"]
    rows = [(" ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=r.randrange(40))), r.choice(["en", "de"]), f"s{r.randrange(7)}") for _ in range(150)]
    rows += [(None, "en", "s1"), ("", None, None), ("A-B_c9d", None, "x"), ("Só ÀB ab av", "en", None), ("only one", "fr", "alone"), (None, "void", "a"), ("x", "void", "b")]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    for min_docs in (10, 3):
        got = rows_of(sd.audit(df, min_docs=min_docs))
        assert len(got) == len(set(got)) and set(got) == plain(rows, min_docs)


@pytest.mark.parametrize("held,cells,pairs", [(300_000, 1 << 18, 1 << 20), (3, 7, 5)])
def test_bounded_tables_give_the_same(spark, monkeypatch, held, cells, pairs):
    import pyarrow as pa
    monkeypatch.setattr(sd, "HELD", held)
    monkeypatch.setattr(sd, "CELLS", cells)
    monkeypatch.setattr(sd, "PAIRS", pairs)
    monkeypatch.setattr(sd, "PIECE", held)
    b = pa.RecordBatch.from_pydict({"lang": ["a", "a", "b"], "source": ["s", "t", "s"], "text": [b"x y x", b"Y yY z", b""]})
    total = collections.Counter()
    for out in sd._count(iter([b, b])):
        for row in out.to_pylist():
            total[row["lang"], row["source"], row["term"], "n"] += row["n"]
            total[row["lang"], row["source"], row["term"], "docs"] += row["docs"]
    assert total["a", "s", "x", "n"] == 4 and total["a", "s", "x", "docs"] == 2 and total["a", "t", "yy", "n"] == 2 and ("b", "s", None, "n") in total

    r = random.Random(1)
    rows = []
    for _ in range(200):
        used = sorted(r.sample(range(6), r.randrange(7)))
        rows.append([(s, n := r.randrange(1, 4), n * 1000 + s, 50 + s) for s in used])
    rows.sort()
    want = collections.Counter()
    for row in rows:
        for i, (a, _, pa_, za) in enumerate(row):
            for b_, _, pb, zb in row[i + 1:]:
                one = [np.array([x]) for x in (pb, pa_, zb, za)]
                want[a, b_] += int(sd._f_of(one[0], one[1])[0] - sd._f_of(one[0], one[3])[0] - sd._f_of(one[2], one[1])[0] + sd._f_of(one[2], one[3])[0])
    tree, got = sd.Tree(), collections.Counter()
    for row in rows:
        tree.insert(np.array(row, np.int64).reshape(-1, 4).T, 1)
    tree.close(0)
    for key, value in zip(*tree.pairs(), strict=True):
        got[int(key >> 32), int(key & 0xFFFFFFFF)] += int(value)
    assert +got == +want and -got == -want


def test_shared_paths_are_worked_out_once():
    """A path of multiplicity n costs one combination for each node and ancestor."""
    tree = sd.Tree()
    path = np.array([[0, 1, 10, 5], [1, 2, 20, 5], [2, 1, 12, 5]], np.int64).T
    tree.insert(path, 1000)
    tree.insert(np.concatenate([path, [[3], [1], [11], [5]]], axis=1), 1)
    tree.close(0)
    assert tree.held == 3 + 3  # pairs of the shared three nodes, and the fourth node's three ancestors
    keys, values = tree.pairs()
    first = int(values[list(keys).index(0 << 32 | 1)])
    assert first % 1001 == 0 and first


def test_counts_beyond_a_long_product(spark):
    """p is exact where SCALE times a count passes a long."""
    from pyspark.sql import functions as F
    big = 1 << 40
    row = spark.range(1).select(sd._p(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (big + 2) // (3 * big + 14)


def test_empty(spark):
    assert rows_of(sd.audit(spark.createDataFrame([], "text string, lang string, source string"))) == []


def test_clashing_names(spark):
    """Inner names as further columns, and as the names of the inputs."""
    names = ["term", "n", "docs", "p", "q", "z", "path", "lo", "hi", "value", "rank", "part", "item", "used", "all", "terms", "total", "other", "times", "row"]
    rows = [("a b c", "en", f"s{k % 3}") for k in range(30)]
    df = spark.createDataFrame([(*r, *["?"] * len(names)) for r in rows], ["text", "lang", "source", *names])
    assert set(rows_of(sd.audit(df))) == plain(rows, 10)
    other = spark.createDataFrame(rows, ["term", "total", "n"])
    assert set(rows_of(sd.audit(other, "term", "total", "n"))) == plain(rows, 10)
