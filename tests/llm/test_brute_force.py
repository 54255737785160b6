"""Every operator against plain Python or the library it must agree with, on the smallest tables."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from roadframe.llm import bpe, common, components, decontaminate, files, html_wrapper, licenses, lm_score, pu_quality, quality_rules, registry, simhash_gph, token_store, warc
from roadframe.session import scratch_path

from .conftest import SMALL

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(str, cur.fetchall()))


def library():
    return Tokenizer.from_file(bpe.word_bpe())


def test_bpe_agrees_with_the_library(spark, texts):
    t = library()
    got = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts():
    t, c = library(), bpe.codec(bpe.word_bpe())
    for x in ("ΑΣ Σ İ ǅ <|endoftext|>x<|startoftext|>", "a\x1cb c", "don't  we'll 12３ ½²", "é café ́x", "한국어 テスト ﬁ ﻿", "ab" * 3000, "\x00\x01 ​", "😀👍🏽 a😀b", "ŉ ſ ß ẞ Ω K"):
        ids = np.frombuffer(c.encode(x), "<i4").tolist()
        assert ids == t.encode(x, add_special_tokens=False).ids
        assert c.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_encoding_and_decoding_take_one_python_pass(spark):
    both = bpe.encode_decode(spark.createDataFrame([("A word",), (None,)], "text string"), bpe.word_bpe())
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = bpe.decode(bpe.encode(spark.createDataFrame([("A word",), (None,)], "text string"), bpe.word_bpe()), bpe.word_bpe())
    assert both.schema == apart.schema and both.collect() == apart.collect()


def test_long_results_come_in_short_batches(spark, monkeypatch):
    from pyspark.sql import types as T
    docs = spark.range(95, numPartitions=1).withColumn("text", F.format_string("a%d b", "id"))
    sizes = common.add_columns(docs, [T.StructField("n", T.LongType())], lambda: lambda b: [pa.array([b.num_rows] * b.num_rows, pa.int64())], 30)
    assert [r.n for r in sizes.orderBy("id").collect()] == [30] * 90 + [5] * 5
    asked, plain = [], common.add_columns
    monkeypatch.setattr(common, "add_columns", lambda *a: (asked.append(a[3:]), plain(*a))[1])
    assert bpe.encode_decode(docs, bpe.word_bpe()).count() == 95 and asked == [(bpe.ROUND_TRIP_ROWS,)]


def test_bpe_white_space_at_the_ends(spark):
    """Separators that only some libraries take for white space, with others before, between and behind them."""
    t = library()
    parts = ["", " ", "\n", "\t\r", "\u00a0", "\u2003", "\x85", "\x0b", "\x0c", "a", "b1!"]
    texts = [x + s + y for s in "\x1c\x1d\x1e\x1f" for x in parts for y in parts] + [s * 2 + " " + s for s in "\x1c\x1f \x85"]
    rows = bpe.encode_decode(spark.createDataFrame([(x,) for x in texts], "text string"), bpe.word_bpe()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == t.encode(r.text, add_special_tokens=False).ids and r.decoded == t.decode(r.ids, skip_special_tokens=False)


def test_decoding_of_odd_ids(spark):
    c = bpe.codec(bpe.word_bpe())
    df = spark.createDataFrame([([1, 2],), (None,), ([],), ([10**6, 5, -1],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(df, bpe.word_bpe()).collect()] == [f"{c.tokens[1]} {c.tokens[2]}", "", "", c.tokens[5]]


def test_segment_tree_merges_leftmost_lowest_rank():
    rnd = random.Random(1)
    for _ in range(300):
        pairs, by_rank = {}, []
        for rank in range(12):
            a, b = rnd.randrange(4 + rank), rnd.randrange(4 + rank)
            if (a, b) not in pairs:
                pairs[a, b] = (len(by_rank), 4 + rank)
                by_rank.append(4 + rank)
        s = [rnd.randrange(4) for _ in range(rnd.randrange(40))]
        want = list(s)
        while found := [(pairs[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in pairs]:
            rank, i = min(found)
            want[i : i + 2] = [by_rank[rank]]
        assert bpe.merge(s, pairs, by_rank) == want


def test_token_store_round_trip(spark, texts):
    t, start = library(), 0
    folder = scratch_path(spark, "test-tokens")
    manifest = token_store.write(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3), folder, lambda: token_store.library_encoder(bpe.word_bpe()))
    got = {r.doc_id: r for r in token_store.read(spark, folder).collect()}
    for i, x in sorted(texts.items()):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        r = got[i]
        assert (r.start, r.n_tokens, r.ids, r.ids_crc32) == (start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    name = manifest["shards"][0]["shard"]
    words = files.read_bytes(folder, "dictionary.zdict")
    assert words and hashlib.sha256(words).hexdigest() == manifest["dictionary_sha256"]
    assert token_store.Shard(folder, name, words).get(1)[-1] == 2  # one document by its offset
    with pytest.raises(ValueError):
        token_store.Shard(folder, name, words + b"x")


def fingerprint(x):
    w = (x or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def groups(fps, bits):
    ids = sorted(fps)
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if low[i] < low[j] and (fps[i] ^ fps[j]).bit_count() <= bits:
                    low[j], changed = low[i], True
    return low


def test_simhash(spark, texts):
    fps = {i: fingerprint(x) for i, x in texts.items()}
    low = groups(fps, 4)
    got = QUERIES["op4_simhash_gph"](spark, SMALL).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", low[i]) for i in texts}


@pytest.mark.parametrize("block", [4, 8192])
def test_links_of_dense_groups(spark, block, monkeypatch):
    rnd = random.Random(2)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5))) for c in centres for _ in range(40)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    monkeypatch.setattr(simhash_gph, "BLOCK", block)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (0, 2, 4):
        found = {r.node: r.root for r in components.components(simhash_gph.links(df, bits)).collect()}
        low = groups(dict(zip(signed, (f % (1 << 64) for f in signed))), bits)
        assert {f: found.get(f, f) for f in signed} == low


def test_thresholds_cover_the_distance():
    rnd = np.random.default_rng(0)
    bits = rnd.random((500, 64)) < rnd.random(64)
    together = (bits.T.astype(int) @ bits.astype(int))
    for n in (500, 10**6, 10**10):
        for most in (0, 1, 4, 7):
            groups_ = simhash_gph.plan(n, (together * (n / 500)).astype(np.int64), most)
            assert sum(t + 1 for _, t in groups_) == most + 1
            used = [b for g, _ in groups_ for b in g]
            assert len(used) == len(set(used))


def test_components_of_chains(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (7, 7)] + [(1000 + rnd.randrange(50), 1000 + rnd.randrange(50)) for _ in range(30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[200] == got[100] == 100
    low = {}
    for a, b in edges:
        low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {n: r for n, r in low.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_wu_manber_against_all_positions():
    rnd = random.Random(4)
    for k in (1, 2, 3, 5):
        patterns = {tuple(rnd.choice([b"a", b"b", b"c"]) for _ in range(k)): {i} for i in range(6)}
        text = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
        want = [(i, patterns[tuple(text[i : i + k])]) for i in range(400 - k + 1) if tuple(text[i : i + k]) in patterns]
        assert list(decontaminate.WuManber(k, patterns).search(text)) == want


def test_benchmark_in_blocks(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {r.doc_id: (r.n_words, r.spans, r["items"]) for r in decontaminate.find(docs, items).collect()}
    parts = {r.doc_id: (r.n_words, r.spans, r["items"]) for r in decontaminate.find(docs, items, block_words=300).collect()}
    assert whole == parts and any(x[1] for x in whole.values())


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10), (0, 1500), (1, 3000), (5, 9000), (20, 17000)]
    p = quality_rules.RISK / len(quality_rules.RULES)
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
    for k, n, t in got:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
        assert t == pytest.approx(want, rel=1e-9)


def test_rules_reject_bad_and_keep_good(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(3, 8)))
    rows = []
    for i in range(4000):
        bad = i % 8 == 0
        rows.append((i, " ".join(word() + ("$$$" if bad else "") for _ in range(30)), "en", 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = quality_rules.judge(df.drop("quality"), df.select("doc_id", "quality")).join(df.select("doc_id", "quality"), "doc_id")
    lost = got.where("quality = 1 AND NOT kept").count()
    assert got.where("quality = 0 AND kept").count() == 0 and lost <= quality_rules.RISK * 3500


def test_classifier_on_held_out_rows(spark, con):
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = QUERIES["op3_pu_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_prior_and_risk(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(6000):
        good = rng.random() < 0.7
        s = np.zeros(pu_quality.N_STATS)
        s[0], s[4] = rng.normal(5, 1), rng.normal(5, 0.4) if good else rng.normal(8, 0.5)
        rows.append((s.astype("<f8").tobytes(), bool(good and rng.random() < 0.4), bool(good)))
    df = spark.createDataFrame(rows, f"{pu_quality.STATS} binary, positive boolean, good boolean")
    model = pu_quality.fit(df)
    assert abs(model.prior - 0.7) < 0.1
    stats = np.stack([np.frombuffer(r[0], "<f8") for r in rows])
    right = (model.score(stats) >= 0.5) == np.array([r[2] for r in rows])
    assert right.mean() > 0.97


def test_language_models(spark, texts, con):
    size = 500
    good = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in lm_score.score(docs, labels.where("quality = 1").select("doc_id"), size=size).collect()}
    tokens = {i: (x or "").lower().split() for i, x in texts.items()}
    counts = collections.Counter(w for ws in tokens.values() for w in ws)
    top = {w for w, _ in sorted(counts.items(), key=lambda z: (-z[1], z[0]))[:size]}
    loss = {i: [] for i in tokens}
    for ids in (good & tokens.keys(), tokens.keys()):
        n, ctx, pair = collections.Counter(), collections.Counter(), collections.Counter()
        walk = lambda i: zip([None, *(w if w in top else 0 for w in tokens[i])], (w if w in top else 0 for w in tokens[i]))
        for i in ids:
            for v, w in walk(i):
                n[w] += 1
                ctx[v] += 1
                pair[v, w] += 1
        for i in tokens:
            s = [-math.log((pair[v, w] + lm_score.MASS * (n[w] + 1) / (n.total() + len(top) + 1)) / (ctx[v] + lm_score.MASS)) for v, w in walk(i)]
            loss[i].append(sum(s) / len(s) if s else None)
    for i, (a, b) in loss.items():
        assert got[i].n_tokens == len(tokens[i])
        if tokens[i]:
            assert (got[i].target_loss, got[i].background_loss, got[i].score) == pytest.approx((a, b, a - b), rel=1e-5, abs=1e-5)


def test_warc_rolls_and_reads_back(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = []
    for _ in range(2):
        folder = scratch_path(spark, "test-warc")
        found.append(warc.write(pages, folder, roll_bytes=20_000))
    assert found[0] == found[1] and len(found[0]["files"]) > 3  # the same bytes each time
    assert found[0]["records"] == pages.count()
    rows = {r.page_id: r for r in warc.read(spark, folder, with_payload=True).collect()}
    assert all(bytes(rows[r.page_id].payload).decode() == r.html for r in pages.collect() if rows[r.page_id].record_type == "response")


def test_main_text(spark, con):
    got = {r.page_id: r.text for r in QUERIES["op8_html_wrapper"](spark, SMALL).collect()}
    for i, page in con.execute("SELECT page_id, html FROM pages").fetchall():
        inside = re.search("<article>(.*?)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("<(?:/?p|/?h1|br)>", inside))
        assert got[i] == "\n".join(p for p in parts if p)


def test_wrappers():
    pages = [f"<body><nav>x</nav><div id=c{k}><h1>t{k}</h1>{'<p>one ' + str(k) + '</p>' * (k + 1)}<span>b</span>{'<table><tr><td>1' if k else ''}</div><p class='cookie-notice'>c</p></body>" for k in range(3)]
    w = html_wrapper.shape(html_wrapper.parse(pages[0]))
    for p in pages[1:]:
        w = html_wrapper.merge(w, html_wrapper.shape(html_wrapper.parse(p)))
    text = html_wrapper.expression(w)
    assert "<h1>(#text)</h1>" in text and "(<table>" in text and ")?" in text and "|" not in text
    assert html_wrapper.extract(pages[1], html_wrapper.decide(w)) == "t1\none 1\nb\n1"


def test_licence_spellings(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT")
    changed = mit.upper().replace("COPYRIGHT (C) <YEAR> <HOLDERS>", "(c) 2019 Somebody\n© Other").replace("LICENSE", "LICENCE", 1).replace(",", " ;")
    rows = [(1, changed), (2, mit + " and more"), (3, "text\nReleased under the MIT Licence.\n")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_table(spark)).collect()}
    assert got[1].license == "MIT" and got[2].license is None and got[3].license is None and got[3].line_licenses == ["MIT"]


def test_pipeline_against_plain_python(spark, texts):
    docs, kept = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        folder = scratch_path(spark, "test-stage")
        docs.write.parquet(folder)
        docs = spark.read.parquet(folder)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})

    def base(x):
        w = [y for y in re.split("[ \x09-\x0d]+", x or "") if y]
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        return len(w) >= 20 and 100 * len(covered) <= 30 * len(w)

    assert kept[0] == {i for i, x in texts.items() if base(x)}  # too few labels here for any certified cutoff
    assert kept[1] <= kept[0] and len(kept[1]) > 0.7 * len(kept[0])
    low = groups({i: fingerprint(texts[i]) for i in kept[1]}, 4)
    assert kept[2] == set(low.values())
    items = duckdb.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall()
    tokens = lambda x: re.findall(rb"[0-9a-z\x80-\xff]+", (x or "").encode().lower())
    windows = {tuple(w[i : i + 10]) for (x,) in items for w in [tokens(x)] for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    clean = {i for i in kept[2] for w in [tokens(texts[i])] if not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))}
    assert kept[3] == kept[4] == clean
    t = library()
    for r in docs.collect():
        assert r.ids == t.encode(r.text, add_special_tokens=False).ids and r.decoded == t.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids)
