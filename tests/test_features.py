import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators.features import add_lags, add_pct_change, add_rolling, build_features


def monthly(spark, values, key="k1", start=(2000, 1)):
    rows = []
    y, m = start
    for v in values:
        rows.append((key, dt.date(y, m, 1), None if v is None else float(v)))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return spark.createDataFrame(rows, "key string, period date, v double")


def test_yoy_literal(spark):
    df = add_pct_change(monthly(spark, range(100, 124)), ["key"], "v", "yoy", 12)
    got = [r.yoy for r in df.orderBy("period").collect()]
    assert all(x is None for x in got[:12])
    assert got[12] == pytest.approx((112 / 100 - 1) * 100)
    assert got[12] == pytest.approx(12.0)


def test_yoy_missing_column(spark):
    with pytest.raises(KeyError):
        add_pct_change(monthly(spark, range(5)), ["key"], "nope", "yoy")


def test_lags_equal_shift(spark):
    vals = list(np.linspace(1, 30, 30))
    df = add_lags(monthly(spark, vals), ["key"], ["v"], 3).orderBy("period").toPandas()
    s = pd.Series(vals)
    for k in (1, 2, 3):
        assert df[f"v_lag_{k}"].astype(float).equals(s.shift(k).astype(float)) or \
            np.allclose(df[f"v_lag_{k}"].astype(float), s.shift(k), equal_nan=True)


def test_rolling_no_lookahead_matches_pandas(spark):
    rng = np.random.default_rng(1)
    vals = list(rng.normal(size=40))
    df = add_rolling(monthly(spark, vals), ["key"], ["v"], [3, 6]).orderBy("period").toPandas()
    s = pd.Series(vals).shift(1)
    for w in (3, 6):
        np.testing.assert_allclose(df[f"v_roll_mean_{w}"].astype(float), s.rolling(w, min_periods=1).mean(), equal_nan=True)
        np.testing.assert_allclose(df[f"v_roll_std_{w}"].astype(float), s.rolling(w, min_periods=1).std(), equal_nan=True)
    # changing the current value does not change its own rolling stat
    vals2 = vals.copy()
    vals2[20] = 1e6
    df2 = add_rolling(monthly(spark, vals2), ["key"], ["v"], [3]).orderBy("period").toPandas()
    assert df2["v_roll_mean_3"][20] == pytest.approx(df["v_roll_mean_3"][20])


def test_panel_keys_are_independent(spark):
    a = monthly(spark, range(1, 20), key="a")
    b = monthly(spark, range(100, 119), key="b")
    df = add_lags(a.unionByName(b), ["key"], ["v"], 1)
    first = df.filter(F.col("period") == dt.date(2000, 1, 1)).collect()
    assert all(r.v_lag_1 is None for r in first)


def test_build_features_required_subset(spark):
    base = monthly(spark, range(100, 160)).withColumns({"x1": F.col("v") * 0.5, "x2": F.col("v") - 3})
    f = build_features(base, ["key"], "v", "t", exog=["x1", "x2"], aliases={"x1": "x1_alias"},
                       max_lag=3, windows=[3])
    pdf = f.orderBy("period").toPandas()
    # target starts at row 12, its lag 1 at row 13
    assert len(pdf) == 60 - 13
    assert {"t_lag_3", "x1_lag_1", "t_roll_std_3", "x1_alias"} <= set(pdf.columns)


def test_unknown_columns_are_skipped(spark):
    df = add_lags(monthly(spark, range(10)), ["key"], ["v", "not_there"], 2)
    df = add_rolling(df, ["key"], ["not_there"], [3])
    assert "v_lag_2" in df.columns and not any(c.startswith("not_there") for c in df.columns)
