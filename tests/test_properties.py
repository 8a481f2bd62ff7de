"""Property checks (hypothesis) against pandas / plain-Python definitions."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.operators.evaluate import fold_rows
from panelcast.operators.features import add_rolling
from panelcast.operators.quality import impute

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def months(n):
    return [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=3, max_size=30)
       .filter(lambda v: any(x is not None for x in v)))
def test_impute_matches_pandas(spark, vals):
    df = spark.createDataFrame([("a", d, v) for d, v in zip(months(len(vals)), vals)], "key string, period date, v double")
    got = impute(df, ["key"], ["v"], drop_all_missing=False).orderBy("period").toPandas().v.astype(float).to_numpy()
    s = pd.Series(vals, index=pd.to_datetime(months(len(vals))), dtype=float)
    pct = round(s.isna().sum() / len(s) * 100, 2)
    if pct == 0:
        exp = s
    elif pct <= 5.0:
        exp = s.ffill().bfill()
    else:
        exp = s.interpolate(method="time").ffill().bfill()
    np.testing.assert_allclose(got, exp.to_numpy(), rtol=1e-9, atol=1e-9)


@settings(**SETTINGS)
@given(st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=2, max_size=40), st.integers(1, 8))
def test_rolling_matches_pandas(spark, vals, w):
    df = spark.createDataFrame([("a", d, v) for d, v in zip(months(len(vals)), vals)], "key string, period date, v double")
    got = add_rolling(df, ["key"], ["v"], [w]).orderBy("period").toPandas()
    s = pd.Series(vals).shift(1)
    np.testing.assert_allclose(got[f"v_roll_mean_{w}"].astype(float), s.rolling(w, min_periods=1).mean(), rtol=1e-7, atol=1e-6, equal_nan=True)
    np.testing.assert_allclose(got[f"v_roll_std_{w}"].astype(float), s.rolling(w, min_periods=1).std(), rtol=1e-6, atol=1e-5, equal_nan=True)


@settings(**SETTINGS)
@given(st.integers(1, 5), st.integers(1, 6), st.integers(0, 20))
def test_fold_rows_follow_reference_split(spark, K, h, extra):
    n = (K + 1) * h + extra
    df = spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(months(n))], "key string, period date, y double")
    got = {(r.fold_idx, r.pos, r.role) for r in fold_rows(df, ["key"], K, h).collect()}
    exp = set()
    for f in range(K):
        test_start = n - (K - f) * h
        exp |= {(f, p, "train") for p in range(test_start)}
        exp |= {(f, p, "test") for p in range(test_start, test_start + h)}
    assert got == exp
