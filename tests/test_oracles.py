"""Every registered query against its DuckDB oracle on the smallest generated tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
HEAVY = {"score_batch"}  # trained in test_model with fewer rounds
LLM = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}  # tested in tests/llm


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - HEAVY - LLM))
def test_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=str)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(E.queries()) - LLM <= set(E.oracle_sql())
