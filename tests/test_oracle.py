"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def own(names):
    """Queries of the library itself; those of the llm subpackage have tests of their own."""
    return sorted(n for n in names if not re.match(r"op\d+_|pipeline$", n))


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", own(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, cur.fetchall())


@pytest.mark.parametrize("name", own(set(E.queries()) - set(E.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    rows = df.count()
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert rows == documents if name in ("adaboost_predictions", "top_attributions") else rows > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"grav", "nb_v", "nb_u", "jour_semaine", "reg", "has_ceinture", "choc_avant"} <= set(df.columns)
