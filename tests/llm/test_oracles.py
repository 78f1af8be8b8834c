import os

import duckdb
import pandas as pd
import pytest

from tables import TINY
from tidemark.llm import queries as q


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted([tuple(None if pd.isna(v) else v for v in r) for r in df[cols].itertuples(index=False)], key=str)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(TINY, t)}.parquet')")
    assert rows(q.queries()[name](spark, TINY).toPandas()) == rows(con.execute(q.oracle_sql()[name]).df())


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in q.queries()] == [f"op{n}" for n in range(1, 14)]
