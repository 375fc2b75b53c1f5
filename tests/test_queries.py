"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check at small scale)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as ENTRY
from claimwise.plans.registry import load_all
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


def canon(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert df.columns == ["slice", "year", "quarter", "cnt", "ratio", "out_of_tolerance"]


def test_every_query_has_an_oracle():
    assert set(load_all()) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_matches_oracle(spark, duck, name):
    df = ENTRY.queries()[name](spark, SF0001)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ENTRY.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == canon(cols, res.fetchall())
