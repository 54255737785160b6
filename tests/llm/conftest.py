import datetime

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

#: Names that operators use for outputs or inside, as columns of the input.
CLASHING = ["ids", "decoded", "score", "spans", "items", "n_words", "kept", "stratum", "positive", "fp", "id", "key", "row", "license", "known", "host", "payload", "part", "target", "quality", "item_id", "h", "held_out"]


def clashing(df):
    return df.withColumns({c: F.lit(f"x{k}") for k, c in enumerate(CLASHING) if c not in df.columns}).withColumn("at", F.lit(datetime.datetime(2020, 1, 1)))


def write_tables(spark, folder, empty):
    sentence = "the quick brown fox jumps over the lazy dog and then sleeps under a green tree until noon because it is tired . "
    texts = [None, "", " \n\t ", "one", "é 한 😀 ΑΣ", sentence * 3, sentence * 3, sentence + sentence.upper(), "word " * 40_000, "x" * 100_000, "a b\nc d\na b\n", "<|endoftext|> in the middle <|startoftext|>",
             "Released under the MIT License.", "copyright 2020 somebody", "#### $$$$ &&&& ||||", "\x00 \x1c   ​", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"]
    docs = [(k, t, ["en", "de", None][k % 3], f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    docs += [(None, sentence, None, None, None), (None, sentence, None, None, None), (5, sentence * 3, "en", "s1", 9), (5, "another text of the same id " * 4, "en", "s1", 9)]
    labels = [(k, k % 2, 0) for k in range(len(texts))] + [(None, 1, 0), (3, 0, 1), (4, None, None)]
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "one"), (2, "one"), (None, "quick brown"), (3, None), (4, ""), (5, "Alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda")]
    page = "<html><body><nav><a href=/>menu</a></nav><article><h1>T</h1><p>" + "long enough body text " * 20 + "</p></article></body></html>"
    pages = [(1, "http://a.example/1", page), (2, "http://a.example/2", page), (3, None, None), (4, "not a url", ""), (5, "http://b.example/\r\nX: y", "<p>a<p>b"), (None, "http://a.example/", page), (None, None, "<div"), (2, "http://a.example/2", page), (6, "http://c.example/", "x" * 200_000)]
    vecs = [(k, [0.1 * (k % 7)] * 64) for k in range(0, 200, 10)] + [(100, [0.6] * 64), (None, [0.5] * 64), (1, None), (2, []), (3, [1.0]), (4, [float("nan")] * 64), (6, [None] * 64)]
    tables = {
        "embeddings": clashing(spark.createDataFrame(vecs, "vec_id long, embedding array<float>")),
        "documents": clashing(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash")),
        "benchmark": spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")),
        "pages": clashing(spark.createDataFrame(pages, "page_id long, url string, html string")),
    }
    for name, df in tables.items():
        (df.where("false") if empty else df).write.parquet(f"{folder}/{name}.parquet")
    return folder, {n: 0 if empty else df.count() for n, df in tables.items()}


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("odd")), empty=False)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("nothing")), empty=True)
