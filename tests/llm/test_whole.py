"""Places where an operator once did less than the whole job."""

import collections
import math
import re
import textwrap
from importlib import resources

import numpy as np
import pytest

from roadframe.llm import bpe, html_wrapper, licenses, lm_score, token_store
from roadframe.session import scratch_path


@pytest.mark.parametrize("size", [None, 40])
def test_models_see_words_beyond_the_broadcast_ones(spark, monkeypatch, size):
    for name, value in (("WORDS", 20), ("START", 21), ("FOLLOWS", 22), ("CONTEXT", 43)):
        monkeypatch.setattr(lm_score, name, value)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) % 90) for _ in range(60)] + ["rare1 rare2 rare1 rare2", "rare3 rare4", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    good = set(range(0, 60, 3)) | {60}
    got = {r.doc_id: r for r in lm_score.score(docs, spark.createDataFrame([(i,) for i in good], "doc_id long"), size=size).collect()}
    tokens = [(t or "").split() for t in texts]
    counts = collections.Counter(w for ws in tokens for w in ws)
    top = {w for w, _ in sorted(counts.items(), key=lambda z: (-z[1], z[0]))[:size]}
    assert len(top) > 20
    means = []
    for ids in (good, range(len(texts))):
        n, ctx, pair = collections.Counter(), collections.Counter(), collections.Counter()
        walk = lambda i: zip([None, *(w if w in top else 0 for w in tokens[i])], (w if w in top else 0 for w in tokens[i]))
        for v, w in (x for i in ids for x in walk(i)):
            n[w] += 1
            ctx[v] += 1
            pair[v, w] += 1
        loss = lambda v, w: -math.log((pair[v, w] + lm_score.MASS * (n[w] + 1) / (n.total() + len(top) + 1)) / (ctx[v] + lm_score.MASS))
        means.append([sum(loss(v, w) for v, w in walk(i)) / len(t) if (t := tokens[i]) else None for i in range(len(texts))])
    for i, t in enumerate(tokens):
        assert got[i].n_tokens == len(t)
        if t:
            assert (got[i].target_loss, got[i].background_loss) == pytest.approx((means[0][i], means[1][i]), rel=1e-5, abs=1e-5)
        else:
            assert got[i].score is None


def licence_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.license for r in licenses.scan(rows, licenses.known_table(spark)).orderBy("doc_id").collect()]


def test_whole_licence_texts_with_and_without_title(spark):
    whole = {n: (resources.files("roadframe.llm") / "license_texts" / f"{n}.txt").read_text() for n in licenses._FILES}
    names = list(whole)
    untitled = {n: t.split("\n\n", 1)[1] for n, t in licenses.KNOWN if n in licenses._TITLES and "\n\n" in t and "License\n" in t}
    header = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except" + whole["Apache-2.0"].split("you may not use this file except")[-1]
    texts = [*whole.values(), *(t[t.index(licenses._FILES[n][0]) :] for n, t in whole.items()), *(f"Copyright (c) 2011, A\n\n{t}" for t in untitled.values()), header, whole["GPL-3.0"] + "one more term"]
    assert licence_of(spark, texts) == [*names, *names, *untitled, "Apache-2.0", None]
    assert {"ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause"} <= set(untitled)


def test_licences_wrapped_hard_and_on_one_line(spark):
    known = {n: t for n, t in reversed(licenses.KNOWN) if n in licenses._TITLES}
    known |= {n: (resources.files("roadframe.llm") / "license_texts" / f"{n}.txt").read_text() for n in licenses._FILES}
    notice = "Copyright (c) 2020 Jane Doe, Inc. <jane@example.org>"
    texts, names = [], []
    for n, t in known.items():
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", t) if "<holders>" not in p]
        if n in licenses._TITLES:
            paragraphs.insert(1, notice)
            texts.append(" ".join(paragraphs[1:]))  # a licence on one line that begins with the notice
            names.append(n)
        texts += ["\n\n".join(textwrap.fill(p, width) for p in paragraphs) for width in (50, 63, 72, 79)]
        texts.append(" ".join(paragraphs))
        names += [n] * 5
    mit = known["MIT"].split("\n\n", 2)[2]
    texts += [f"{notice} Commercial use is prohibited. {' '.join(mit.split())}", "copyright notice and this", "Copyright 2020 A\n\u00a9 B", "Copyright law is old"]
    got = licence_of(spark, texts)
    assert [(a, b, t[:60]) for a, b, t in zip(got, [*names, None, None, None, None], texts, strict=True) if a != b] == []
    kept = spark.createDataFrame([(t,) for t in texts[-3:]], "t string").select(licenses.digest(licenses.F.col("t")) != licenses.EMPTY).collect()
    assert [r[0] for r in kept] == [True, False, True]


def test_all_lines_of_isc_at_every_width(spark):
    isc = " ".join(next(t for n, t in licenses.KNOWN if n == "ISC").split("\n\n", 1)[1].split())
    assert set(licence_of(spark, ["ISC License\n\n" + textwrap.fill(isc, w) for w in range(40, 100)])) == {"ISC"}


def main_texts(pages):
    w = None
    for p in pages:
        one = html_wrapper.shape(html_wrapper.parse(p))
        w = html_wrapper.merge(w, one) if w else one
    return [html_wrapper.extract(p, html_wrapper.decide(w)) for p in pages]


def test_repeats_and_copies_are_not_template():
    assert main_texts(["<body>" + "<p>same</p>" * 5]) == ["\n".join(["same"] * 5)]
    cells = "<table><tr>" + "<td>0</td>" * 6 + "</tr></table>"
    assert main_texts([f"<article><h1>t{k}</h1>{cells if k == 2 else ''}<p>x{k}</p></article>" for k in range(4)])[2] == "\n".join(["t2", *"000000", "x2"])
    assert main_texts(["<body><h1>T</h1><p>a</p><p>b</p>"] * 7) == ["T\na\nb"] * 7
    assert main_texts([f"<article><div>by us</div><p>x{k}</p></article>" for k in range(5)]) == [f"x{k}" for k in range(5)]


def test_furniture_words_and_frames():
    for frame in ("div class='layout has-sidebar'", "div class='content no-comments'", "form", "div class=header"):
        pages = [f"<body><{frame}><nav>menu</nav><div class='article-header'><h1>title {k}</h1></div><p>long text {k}</p></{frame.split()[0]}><div class='sidebar'>s{k}</div></body>" for k in range(6)]
        assert main_texts(pages) == [f"title {k}\nlong text {k}" for k in range(6)]
    assert main_texts([f"<form><nav>m</nav><article><h1>t{k}</h1><p>x</p></article></form>" for k in range(3)]) == [f"t{k}\nx" for k in range(3)]
    assert main_texts(["<body><svg width='1'/><p>one</p><p>two</p><svg><text>no</text></svg></body>"]) == ["one\ntwo"]


def test_dotted_capital_i_before_a_stop():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.word_bpe())
    texts = ["ANKARA B\u0130R\u0130NC\u0130S\u0130.", "\u0130,", "a \u0130. \u0130", "i\u0307. \u0131. \u0130s."]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(memoryview(x).cast("I")) for x in token_store.LibraryEncoder(bpe.word_bpe()).many(texts)] == expected
    assert [list(memoryview(bytes(bpe.codec(bpe.word_bpe()).encode(t))).cast("I")) for t in texts] == expected


def test_nothing_else_of_the_article_is_dropped():
    motto = "<blockquote>our motto</blockquote>"
    assert main_texts([f"<article>Dear reader<h1>t{k}</h1>{motto}<p>x{k}</p><ul><li><div>one</div></ul></article>" for k in range(6)]) == [f"Dear reader\nt{k}\nour motto\nx{k}\none" for k in range(6)]
    pages = [f"<body><article><h1>t{k}</h1><p>{'long text ' * 40}{k}</p></article><article><p>update {k} is news</p></article></body>" for k in range(6)]
    assert main_texts(pages) == [f"t{k}\n{'long text ' * 40}{k}\nupdate {k} is news" for k in range(6)]
    header = "<header><nav><h2>menu</h2></nav><div><div class=x><h1>title {}</h1></div><span>by us</span></div></header>"
    assert main_texts([f"<body><header><div><h1>Site</h1></div></header><article>{header.format(k)}<p>x{k}</p></article></body>" for k in range(6)]) == [f"title {k}\nx{k}" for k in range(6)]


def test_reader_comments():
    marks = ("article class=comment", "article class='comment-body'", "div id=disqus_thread", "div role=comment", "div itemprop='comment'", "li itemscope itemtype='https://schema.org/Comment'", "section class='comments'")
    for m in marks:
        said = f"<{m}><p>I say {{k}} and more and more</p></{m.split()[0]}>"
        for page in ("<article><h1>t{k}</h1><p>x{k}</p>" + said + "</article>", "<article><h1>t{k}</h1><p>x{k}</p></article>" + said, "<div><h1>t{k}</h1><p>x{k}</p></div>" + said):
            assert main_texts([f"<body>{page}</body>".replace("{k}", str(k)) for k in range(6)]) == [f"t{k}\nx{k}" for k in range(6)], (m, page)


def test_hot_host_by_layout(spark):
    pages = [(i, "http://a/x", f"<body><nav>m</nav><article><h1>t{i}</h1>{'<p>p' + str(i) + '</p>' * (i % 3)}{'<div>by us</div>' if i % 2 else ''}</article><p>foot</p></body>") for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = [sorted((r.page_id, r.text) for r in html_wrapper.main_text(df.repartition(n)).collect()) for n in (1, 7, 40)]
    assert found[0] == found[1] == found[2] and all(t for _, t in found[0])
    assert html_wrapper.wrappers(df.repartition(40).selectExpr("'a' AS host", "html AS page")).count() == 1


def test_siblings_with_variable_text_are_kept():
    pages = [f"<body><div class=top><a href=x>all {k}</a></div><div class=lead>lead {k}</div><div class=text><p>{'long ' * 20}{k}</p></div></body>" for k in range(6)]
    assert main_texts(pages) == [f"lead {k}\n{'long ' * 20}{k}" for k in range(6)]


def test_dictionary_sample_has_different_texts(spark):
    hash_of = lambda texts: {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}
    texts = [f"text {k} has words of its own such as {' '.join(str(k * j % 97) for j in range(60))}" for k in range(200)]
    first = min((h := hash_of(texts)), key=h.get)
    docs = spark.createDataFrame(list(enumerate(texts + [first] * 400)), "doc_id long, text string")
    encoder = lambda: token_store.library_encoder(bpe.word_bpe())
    manifest = token_store.write(docs, scratch_path(spark, "test-copies"), encoder, sample_rows=100)
    assert manifest["dictionary_trained"]
    once = token_store.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), scratch_path(spark, "test-copies"), encoder, sample_rows=100)
    assert manifest["dictionary_sha256"] == once["dictionary_sha256"]
    none = token_store.write(docs.where("doc_id < 2"), scratch_path(spark, "test-copies"), encoder)
    assert not none["dictionary_trained"]


def test_ids_of_many_runs_by_bytes_and_by_offsets():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(bpe.word_bpe())
    runs = ["a", "it's", "x<|endoftext|>y", "<|startoftext|>", "#", "Ünïcödé", "don't.", "1234", "Å", "été", "İstanbul.", "中文", "a­", "ŉ", "ŒUVRE", "-", "zzqj" * 50, "\x00", "ﬁn"]
    expected = [plain.encode(r, add_special_tokens=False).ids for r in runs]
    for some in (runs, runs[:6], runs[8:10], runs[::-1]):
        got = [list(memoryview(x).cast("I")) for x in token_store.LibraryEncoder(bpe.word_bpe()).run_ids(some)]
        assert got == [expected[runs.index(r)] for r in some]


def test_documents_are_scored_in_one_python_pass(spark, odd):
    from roadframe.llm import pu_quality
    from roadframe.session import read_table
    docs, labels = (read_table(spark, odd[0], t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text", "lang")
    got = pu_quality.score_documents(docs, labels)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # two hold two Python workers for each task
    model = pu_quality.fit(pu_quality.training_rows(docs, labels).where("NOT held_out"))
    want = pu_quality.score(pu_quality.with_statistics(docs), model)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
