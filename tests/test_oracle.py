"""Every registered query against its DuckDB oracle (sf0.001): same columns,
same rows, same values."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tickfold import oracle as _oracle
from tickfold import queries as _queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def _rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


OWN = sorted(_queries.queries())


def test_every_query_has_an_oracle():
    assert set(OWN) == set(_oracle.oracle_sql())
    assert set(OWN) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(got, df.columns) == _rows(exp, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "ticker", "company_name", "avg_price", "volume", "market_index"]
    assert df.count() > 0
