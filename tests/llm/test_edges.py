"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables: every query and every stage."""

import duckdb
import pytest

import corpus_pipeline
from roadframe.llm import registry

QUERIES = registry.queries()
OWN = sorted(n for n in QUERIES if n != "pipeline")
#: Queries whose rows are not those of their table: held against their SQL on the same odd tables.
OTHER = ("op11_source_divergence", "op12_ns_bounds", "op13_topk_blocks")


def size(name, rows):
    return rows["pages" if name in ("op6_warc", "op8_html_wrapper") else "documents"]


@pytest.mark.parametrize("name", OTHER)
def test_odd_rows_by_sql(spark, odd, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{odd[0]}/{t}.parquet/*.parquet')")
    df = QUERIES[name](spark, odd[0])
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    rows = sorted(map(str, (tuple(r[n] for n in names) for r in df.collect())))
    assert rows and rows == sorted(map(str, cur.fetchall()))


@pytest.mark.parametrize("name", [n for n in OWN if n not in OTHER])
def test_odd_rows(spark, odd, name):
    folder, rows = odd
    assert len(QUERIES[name](spark, folder).collect()) == size(name, rows)


@pytest.mark.parametrize("name", OWN)
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing[0]).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_odd_rows(spark, odd, nothing, stage):
    for folder, rows in (odd, nothing):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = stage[1](spark, docs, folder)
        assert out.count() <= rows["documents"]
        if stage is not corpus_pipeline.STAGES[-1]:
            assert out.columns == docs.columns


def test_pipeline_on_empty_tables(spark, nothing):
    assert QUERIES["pipeline"](spark, nothing[0]).count() == 0


def test_odd_results(spark, odd):
    folder, _ = odd
    bpe = [(r.doc_id, r.n_tokens) for r in QUERIES["op7_bpe"](spark, folder).collect()]
    assert (0, 0) in bpe and (1, 0) in bpe and (3, 1) in bpe
    store = QUERIES["op2_token_store"](spark, folder).collect()
    assert sorted(r.start for r in store)[0] == 0 and sum(r.n_tokens for r in store) == sum(n for _, n in bpe) + len(bpe)
    warc = {(r.page_id, r.record_type, r.refers_to) for r in QUERIES["op6_warc"](spark, folder).collect()}
    assert warc >= {(1, "response", None), (2, "revisit", 1), (3, "response", None), (None, "revisit", 1), (None, "response", None)}
    hit = {r.doc_id: r for r in QUERIES["op5_decontaminate"](spark, folder).collect() if r.doc_id is not None}
    assert hit[3].contaminated and hit[3].n_items == 1 and hit[16].n_items == 2 and hit[16].n_hit == 11 and not hit[0].contaminated
    assert hit[7].n_hit > 0 and hit[7].n_items == 0  # an item of null id marks words and is not named
    sims = {r.doc_id: r for r in QUERIES["op4_simhash_gph"](spark, folder).collect() if r.doc_id not in (None, 5)}
    assert sims[0].component_id == sims[1].component_id == sims[2].component_id == 0 and sims[6].component_id == 5
    rules = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, folder).collect()}
    assert rules[0].n_words == 0 and rules[0].base_failed and not rules[0].kept and rules[10].n_dup_lines == 1 and rules[8].n_repeat_words == 40_000
    found = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, folder).collect()}
    assert found[12].license == "MIT" and found[12].line_licenses == "MIT" and found[13].text_digest is None and found[0].license is None
    texts = {r.page_id: r.text for r in QUERIES["op8_html_wrapper"](spark, folder).collect() if r.page_id is not None}
    assert texts[3] == texts[4] == "" and texts[5] == "a\nb" and texts[1].startswith("T\nlong enough") and "menu" not in texts[1]
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert kept.where("text LIKE 'the quick%tired . '").count() >= 1 and kept.where("doc_id = 5").count() == 2
