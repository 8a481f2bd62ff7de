import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators.forecast import last_values, naive_forecast, recursive_linear_forecast


def reference_loop(coefs, const, x_last, names, hist, h, target):
    """The reference's recursion written as a plain loop (test oracle)."""
    row = dict(x_last)
    buf = list(hist)
    out = []
    for _ in range(h):
        p = const + sum(coefs[n] * row[n] for n in names)
        out.append(p)
        buf.append(p)
        for n in names:
            if n.startswith(f"{target}_lag_"):
                k = int(n.rsplit("_", 1)[1])
                row[n] = buf[-k]
    return out


def test_recursion_matches_loop(spark):
    names = ["x", "y_lag_1", "y_lag_3"]
    coefs = {"x": 0.3, "y_lag_1": 0.6, "y_lag_3": -0.2}
    x_last = {"x": 2.0, "y_lag_1": 1.5, "y_lag_3": 0.7}
    hist = [0.9, 1.2, 1.6]
    st = spark.createDataFrame([("a", dt.date(2020, 12, 1), *[x_last[n] for n in names], *[coefs[n] for n in names], 0.1, hist)],
                               "key string, last_period date, x double, y_lag_1 double, y_lag_3 double, "
                               "b0 double, b1 double, b2 double, c double, history array<double>")
    got = recursive_linear_forecast(st, ["key"], "y", names, ["b0", "b1", "b2"], "c", 12).orderBy("step").collect()
    exp = reference_loop(coefs, 0.1, x_last, names, hist, 12, "y")
    assert [r.yhat for r in got] == pytest.approx(exp)
    assert got[0].period == dt.date(2021, 1, 1) and got[-1].period == dt.date(2021, 12, 1)
    assert len(set(round(r.yhat, 9) for r in got)) > 1


def test_last_values_bounded_and_ordered(spark):
    df = spark.createDataFrame([("a", dt.date(2000, m, 1), float(m)) for m in range(1, 13)],
                               "key string, period date, y double")
    r = last_values(df, ["key"], "y", 3).collect()[0]
    assert r.history == [10.0, 11.0, 12.0]


def test_naive_forecast(spark):
    df = spark.createDataFrame([("a", dt.date(2000, m, 1), float(m)) for m in range(1, 7)],
                               "key string, period date, y double")
    f = naive_forecast(df, ["key"], "y", 4).orderBy("step").collect()
    assert [r.yhat for r in f] == [6.0] * 4 and f[0].period == dt.date(2000, 7, 1)
    _ = F


def test_model_recursion_matches_loop(spark):
    """A Spark ML linear model rolled forward equals the plain loop."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from panelcast.operators.forecast import recursive_model_forecast
    from panelcast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rows = []
    for i in range(40):
        x, l1, l3 = float(i % 5), float((i * 7) % 11), float((i * 3) % 13)
        rows.append((x, l1, l3, 0.1 + 0.3 * x + 0.6 * l1 - 0.2 * l3))
    train = spark.createDataFrame(rows, "x double, y_lag_1 double, y_lag_3 double, label double")
    names = ["x", "y_lag_1", "y_lag_3"]
    model = LinearRegression(featuresCol="features", regParam=0.0).fit(
        VectorAssembler(inputCols=names, outputCol="features").transform(train))
    st = spark.createDataFrame([("a", dt.date(2020, 12, 1), 2.0, 1.5, 0.7, [0.9, 1.2, 1.6])],
                               "key string, last_period date, x double, y_lag_1 double, y_lag_3 double, history array<double>")
    got = recursive_model_forecast(st, ["key"], "y", names, model, 9, checkpoint_every=4).orderBy("step").collect()
    coefs = dict(zip(names, model.coefficients.toArray().tolist()))
    exp = reference_loop(coefs, model.intercept, {"x": 2.0, "y_lag_1": 1.5, "y_lag_3": 0.7}, names, [0.9, 1.2, 1.6], 9, "y")
    assert [r.yhat for r in got] == pytest.approx(exp, rel=1e-9)
