import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelcast.operators import report as R


def test_trend_phrases(spark):
    df = spark.createDataFrame([(1.0, 1.5, 3), (1.0, 0.5, 3), (1.0, 1.1, 3), (1.0, 9.0, 1)], "a double, b double, n int")
    got = [r.t for r in df.select(R.trend_phrase(F.col("a"), F.col("b"), F.col("n")).alias("t")).collect()]
    assert got == [R.TREND_UP, R.TREND_DOWN, R.TREND_FLAT, R.TREND_SHORT]


def test_comparison_table_na_and_order(spark):
    s = spark.createDataFrame([("k", "LSTM", 1.0, None, 3.0), ("k", "OLS", 1.23456, 2.0, 3.14159)],
                              "key string, model string, mae_mean double, rmse_mean double, mape_mean double")
    md = R.comparison_table(s, ["key"]).collect()[0].comparison_md
    lines = md.splitlines()
    assert lines[2] == "| OLS | 1.2346 | 2.0000 | 3.14 |"
    assert lines[3] == "| LSTM | 1.0000 | N/A | 3.00 |"


def test_json_roundtrip_nan_to_null(spark):
    df = spark.createDataFrame([("a", float("nan"), {"x": 1.0})], "key string, v double, m map<string,double>")
    js = R.to_json_rows(df, ["key"]).collect()[0].json
    obj = json.loads(js)  # valid JSON: no bare NaN token
    assert obj["v"] is None and obj["m"] == {"x": 1.0}
    d = tempfile.mkdtemp(prefix="panelcast-json-", dir="/tmp")
    R.write_json(df.withColumn("v", R.nan_safe(F.col("v"))), os.path.join(d, "ev"))
    back = R.read_json(spark, os.path.join(d, "ev"), "key string, v double, m map<string,double>").collect()[0]
    assert back.key == "a" and back.v is None and back.m == {"x": 1.0}


def test_config_hash_matches_hashlib():
    import hashlib
    meta = R.run_metadata({"b": 1, "a": [1, 2]})
    exp = hashlib.sha256(json.dumps({"a": [1, 2], "b": 1}, sort_keys=True).encode()).hexdigest()[:8]
    assert meta["config_hash"] == exp and len(meta["run_id"]) == 8


def test_chart_tail(spark):
    rows = [("a", dt.date(2000 + i // 12, i % 12 + 1, 1), float(i)) for i in range(50)]
    hist = spark.createDataFrame(rows, "key string, period date, y double")
    fc = spark.createDataFrame([("a", 1, dt.date(2004, 3, 1), 1.0)], "key string, step int, period date, yhat double")
    c = R.chart_data(hist, fc, ["key"], "y", 36, 2.0)
    counts = {r.series: r["count"] for r in c.groupBy("series").count().collect()}
    assert counts == {"history": 36, "forecast": 1, "reference": 37}


@pytest.mark.slow
def test_pipeline_end_to_end(spark):
    from panelcast.plans.q_report import run_panel_d
    from tests.conftest import SF_SMALL
    out = run_panel_d(spark, SF_SMALL)
    fc = out.table("forecast").collect()
    keys = {(r.l_returnflag, r.l_linestatus) for r in fc}
    assert all(sum(1 for r in fc if (r.l_returnflag, r.l_linestatus) == k) == 12 for k in keys)
    md = out.table("markdown").collect()
    assert len(md) == len(keys) and all("## 7. Reproducibility" in r.markdown for r in md)
    ev = out.table("evidence").collect()[0]
    assert 0 <= ev.durbin_watson <= 4 and ev.best_rmse > 0 and len(ev.forecast_values) == 12
