"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import datetime as dt
import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    s = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    d = _canon([c[0] for c in cur.description], cur.fetchall())
    assert s[0] == d[0]
    assert len(s[1]) == len(d[1])
    assert s[1] == d[1]


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(E.queries()) - set(E.oracle_sql())
    assert {q for q in rows_only if not re.match(r"op\d+_|pipeline$", q)} == set()
