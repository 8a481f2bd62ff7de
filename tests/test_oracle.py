"""Every registered query against its DuckDB SQL on the small tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from panelcast.sources.tables import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        s = v.isoformat()[:19]
        return s[:10] if s.endswith("T00:00:00") or len(s) == 10 else s
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
