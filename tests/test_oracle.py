"""Every registered query vs its DuckDB oracle on sf0.001 (the driver gate runs sf0.01)."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tidemark import catalog
from helpers import SF_SMALL

SQLS = catalog.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for _, r in df.iterrows()]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    return cols, sorted(out, key=key)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_entry():
    qs = catalog.queries()
    assert set(SQLS) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, duck, name):
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQLS[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQLS)))
def test_rows_only_queries_run(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "window_start", "window_end", "vwap", "volatility", "rsi",
                          "volume", "trade_count", "high", "low"]
