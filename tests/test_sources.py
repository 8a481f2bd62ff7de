import datetime as dt
import os
import tempfile

import pytest

from panelcast.sources.io import (
    ModelRegistry,
    coerce_numeric,
    fetch_all,
    load_with_fallback,
    read_csv_series,
    read_long_series,
)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="panelcast-test-", dir="/tmp")


def test_csv_scan_coerces_and_parses(spark, scratch):
    p = os.path.join(scratch, "macro.csv")
    with open(p, "w") as fh:
        fh.write("date,A,B\n2000-01-01,1.5,x\n2000-02-01,,2\n")
    df = read_csv_series(spark, p, ["A", "B"]).orderBy("date").collect()
    assert df[0].date == dt.date(2000, 1, 1) and df[0].A == 1.5 and df[0].B is None
    assert df[1].A is None and df[1].B == 2.0


def test_csv_missing_file(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_csv_series(spark, os.path.join(scratch, "nope.csv"), ["A"])


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1",), ("bad",)], "v string")
    assert [r.v for r in coerce_numeric(df, ["v"]).collect()] == [1.0, None]


def test_long_scan_pushdown_and_align(spark, scratch):
    rows = [(s, dt.date(2000, m, 1), float(m * (i + 1))) for i, s in enumerate(["A", "B", "C"]) for m in range(1, 13)]
    rows = [r for r in rows if not (r[0] == "B" and r[1].month == 5)]
    p = os.path.join(scratch, "long.parquet")
    spark.createDataFrame(rows, "series_id string, date date, value double").write.parquet(p)
    df = read_long_series(spark, p, ["A", "B"], "2000-03-01", "2000-06-30")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(series_id" in plan
    assert {r.series_id for r in df.collect()} == {"A", "B"}
    wide = fetch_all(spark, p, ["A", "B"], "2000-03-01", "2000-06-30").orderBy("date").collect()
    assert len(wide) == 4 and wide[2]["B"] is None  # full outer: May exists for A only


def test_fallback_rules(spark):
    good = lambda: spark.range(1)

    def bad():
        raise RuntimeError("down")
    assert load_with_fallback(bad, good, "auto")[1] == "fallback"
    assert load_with_fallback(good, good, "auto")[1] == "primary"
    assert load_with_fallback(good, good, "primary", primary_available=False)[1] == "fallback"
    with pytest.raises(RuntimeError):
        load_with_fallback(bad, good, "primary")


def test_registry():
    r = ModelRegistry()
    r.register("OLS", object())
    assert r.list_models() == ["OLS"]
    with pytest.raises(KeyError):
        r.get("LSTM")
