"""Driver contract: entry(), queries() and oracle_sql()."""

import collections
import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from ledgerwatch.plans import queries as _q

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), collections.Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(_q.REGISTRY) - set(o) == set()


@pytest.mark.parametrize("name", sorted(_q.REGISTRY))
def test_oracle_agreement_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = entry.queries()[name](spark, SF001)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    exp = _bag([d[0] for d in cur.description], cur.fetchall())
    assert got == exp
