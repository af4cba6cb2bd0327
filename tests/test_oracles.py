"""Every registered query against its DuckDB oracle, as the driver checks it (small fixture)."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tableferry.oracles import ORACLES as _ORACLES
from tableferry.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ORACLES = dict(_ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.10g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def test_every_query_is_registered():
    q = QUERIES
    assert set(q) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert len(q) >= 60
    assert set(ORACLES) <= set(q)
    assert set(q) - set(ORACLES) == set()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    exp = sorted(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == exp


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 14 and all(r.is_valid for r in rows)
