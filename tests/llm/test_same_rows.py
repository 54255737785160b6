"""Operators on inputs that give other rows or another order when they are read again, and on columns named like inner ones."""

import pytest
from pyspark.sql import functions as F

from roadframe.llm import bpe, decontaminate, html_wrapper, licenses, quality_rules, simhash_gph

from .conftest import SMALL

INNER = ["known", "name", "row", "names", "stratum", "cut_symbols", "host", "decision", "digest", "line", "gone", "key", "id", "fp", "component_id", "node", "root", "low", "salt", "page", "ids", "spans"]


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def shaken(df):
    return [df.repartition(5), df.orderBy(F.rand(7)).repartition(3), df.union(df.limit(0)).repartition(4, "lang")]


def by_id(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("inline", [1000, 0])
def test_scan_of_shuffled_documents(spark, monkeypatch, inline):
    monkeypatch.setattr(licenses, "INLINE_ROWS", inline)
    docs = documents(spark)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\nReleased under the MIT License."))).otherwise(F.col("text")))
    known, cols = licenses.known_table(spark), ("text_digest", "license", "line_licenses")
    want = by_id(licenses.scan(docs, known), *cols)
    assert sum(bool(x[2]) for x in want.values()) >= 60
    for df in shaken(docs):
        assert by_id(licenses.scan(df, known), *cols) == want
    some = by_id(licenses.scan(docs.repartition(5).limit(80), known), *cols)
    assert len(some) == 80 and all(want[k] == v for k, v in some.items())


def test_both_ways_to_look_up_agree(spark, odd, monkeypatch):
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet").select("text")
    known = licenses.known_table(spark)
    found = []
    for inline in (1000, 0):
        monkeypatch.setattr(licenses, "INLINE_ROWS", inline)
        found.append(sorted(map(str, licenses.scan(docs, known).collect())))
    assert found[0] == found[1]
    none = spark.createDataFrame([], "license string, text string")
    assert all(r.license is None and r.line_licenses == [] for r in licenses.scan(docs, none).collect())


def test_one_of_each_group_stays_whatever_the_order(spark):
    docs = documents(spark)
    copies = docs.unionByName(docs.where("doc_id % 4 = 0").withColumn("doc_id", F.col("doc_id") + 100_000))
    want = sorted(r.doc_id for r in simhash_gph.deduplicate(copies).collect())
    assert want[-1] < 100_000
    for df in shaken(copies):
        assert sorted(r.doc_id for r in simhash_gph.deduplicate(df).collect()) == want
    some = simhash_gph.deduplicate(copies.repartition(5).limit(90)).collect()
    assert 0 < len(some) <= 90


def inner(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in INNER if c not in df.columns])


def carried(out, replaced=()):
    rows = out.collect()
    return rows and all(r[c] == f"own {c}" for r in rows for c in INNER if c not in replaced)


def test_inner_names(spark, monkeypatch):
    docs = inner(documents(spark).limit(40))
    labels, known = spark.read.parquet(f"{SMALL}/labels.parquet"), licenses.known_table(spark)
    assert carried(quality_rules.judge(docs, labels))
    for inline in (1000, 0):
        monkeypatch.setattr(licenses, "INLINE_ROWS", inline)
        assert carried(licenses.scan(docs, known))
    assert carried(simhash_gph.deduplicate(docs))
    assert carried(decontaminate.find(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")), ("spans",))
    assert carried(bpe.encode_decode(docs, bpe.word_bpe()), ("ids",))
    pages = inner(spark.read.parquet(f"{SMALL}/pages.parquet").limit(40))
    for hosts in (20_000, 0):
        monkeypatch.setattr(html_wrapper, "BROADCAST_HOSTS", hosts)
        assert carried(html_wrapper.main_text(pages))
