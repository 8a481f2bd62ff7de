import datetime as dt

import numpy as np
import pandas as pd
import pytest

from panelcast.operators.calendar import fill_spine, resample_last
from panelcast.operators.quality import DataQualityError, impute, interp_time, missing_pct, validate, validate_strict


def months(n):
    return [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]


def frame(spark, vals, key="a"):
    return spark.createDataFrame([(key, d, v) for d, v in zip(months(len(vals)), vals)],
                                 "key string, period date, v double")


def test_interp_time_matches_pandas(spark):
    vals = [None, 1.0, None, None, 4.0, 5.0, None, 9.0, None, None]
    got = frame(spark, vals).select("period", interp_time("v", ["key"]).alias("vi")).orderBy("period").toPandas()
    s = pd.Series(vals, index=pd.to_datetime(months(len(vals))), dtype=float).interpolate(method="time")
    np.testing.assert_allclose(got.vi.astype(float).to_numpy(), s.to_numpy(), equal_nan=True)


def test_policy_low_gap_uses_fill(spark):
    vals = [float(i) for i in range(40)]
    vals[5] = None  # 2.5 % missing -> ffill
    out = impute(frame(spark, vals), ["key"], ["v"]).orderBy("period").toPandas()
    assert out.v[5] == pytest.approx(4.0)


def test_policy_high_gap_interpolates_then_backfills(spark):
    vals = [None, None, 2.0, None, 4.0, None, None, 7.0, None, 9.0]
    out = impute(frame(spark, vals), ["key"], ["v"]).orderBy("period").toPandas()
    s = pd.Series(vals, index=pd.to_datetime(months(10)), dtype=float).interpolate(method="time").ffill().bfill()
    np.testing.assert_allclose(out.v.astype(float), s.to_numpy())


def test_missing_pct_two_decimals(spark):
    vals = [1.0, None, 3.0]
    r = missing_pct(frame(spark, vals), ["key"], ["v"]).collect()[0]
    assert r.missing_pct == pytest.approx(33.33)


def test_spine_and_resample_last(spark):
    rows = [("a", dt.datetime(2000, 1, 5), 1.0, 1), ("a", dt.datetime(2000, 1, 20), None, 2),
            ("a", dt.datetime(2000, 1, 20), 2.0, 3), ("a", dt.datetime(2000, 4, 2), 5.0, 4)]
    raw = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v double, id int")
    r = resample_last(raw, ["key"], "ts", ["v"], tiebreak=["id"])
    s = fill_spine(r, ["key"]).orderBy("period").collect()
    assert [x.period for x in s] == months(4)
    assert [x.v for x in s] == [2.0, None, None, 5.0]


def test_validate_errors(spark):
    short = frame(spark, [1.0] * 10)
    rep = validate(short, ["key"], required=["v"], min_obs=36, positive=["v"])
    assert {r.check for r in rep.collect()} == {"insufficient_data"}
    with pytest.raises(DataQualityError):
        validate_strict(rep)
    with pytest.raises(DataQualityError, match="Missing required columns"):
        validate(short, ["key"], required=["rate_missing"])


def test_impute_drops_rows_without_any_value(spark):
    import datetime as dt

    from panelcast.operators.quality import impute
    rows = [("a", dt.date(2000, m, 1), None if m == 2 else float(m)) for m in range(1, 5)] + [("b", dt.date(2000, m, 1), None) for m in (1, 2)]
    got = impute(spark.createDataFrame(rows, "k string, period date, v double"), ["k"], ["v"]).collect()
    assert sorted((r.k, r.period.month, r.v) for r in got) == [("a", 1, 1.0), ("a", 2, pytest.approx(2.0, abs=0.1)), ("a", 3, 3.0), ("a", 4, 4.0)]
