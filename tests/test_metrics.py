import math

import pytest
from pyspark.sql import functions as F

from panelcast.operators.evaluate import fold_summary, metrics, select_best


def pairs(spark, yt, yp, group="g"):
    return spark.createDataFrame([(group, float(a) if a is not None else None, float(b) if b is not None else None)
                                  for a, b in zip(yt, yp)], "g string, y_true double, y_pred double")


def m(spark, yt, yp):
    return metrics(pairs(spark, yt, yp), ["g"]).collect()[0]


def test_mae_rmse_mape_constants(spark):
    assert m(spark, [1, 2, 3], [2, 3, 4]).mae == pytest.approx(1.0)
    assert m(spark, [0, 0, 0], [1, 1, 1]).rmse == pytest.approx(1.0)
    assert m(spark, [2, 4], [1, 3]).mape == pytest.approx(37.5)


def test_zero_denominator_is_finite(spark):
    r = m(spark, [0, 1], [0.5, 1.5])
    assert math.isfinite(r.mape)


def test_nan_and_inf_pairs_dropped(spark):
    df = spark.createDataFrame([("g", 1.0, 2.0), ("g", float("nan"), 1.0), ("g", 3.0, float("inf"))],
                               "g string, y_true double, y_pred double")
    r = metrics(df, ["g"]).collect()[0]
    assert r.mae == pytest.approx(1.0)


def test_all_missing_gives_null(spark):
    df = spark.createDataFrame([("g", float("nan"), 1.0)], "g string, y_true double, y_pred double")
    r = metrics(df, ["g"]).collect()[0]
    assert r.mae is None and r.rmse is None and r.mape is None


def test_fold_summary_population_std(spark):
    fm = spark.createDataFrame([("m", 0, 1.0, 2.0, 10.0), ("m", 1, 3.0, 4.0, 20.0)],
                               "model string, fold_idx int, mae double, rmse double, mape double")
    r = fold_summary(fm, ["model"]).collect()[0]
    assert r.mae_mean == pytest.approx(2.0)
    assert r.mae_std == pytest.approx(1.0)
    one = fold_summary(fm.filter("fold_idx = 0"), ["model"]).collect()[0]
    assert one.mae_std == pytest.approx(0.0)


def test_select_best_tie_breaks(spark):
    board = spark.createDataFrame([
        ("s", "GradientBoosting", 1.0, 0.5, 3.0, 0),
        ("s", "OLS", 1.0, 0.5, 3.0, 1),
        ("s", "LSTM", None, None, None, 2),
        ("t", "ARIMA", None, None, None, 0),
        ("t", "OLS", None, None, None, 1),
    ], "k string, model string, rmse_mean double, mae_mean double, mape_mean double, model_order int")
    best = {r.k: r.model for r in select_best(board, ["k"]).collect()}
    assert best["s"] == "OLS"          # equal scores -> preference order
    assert best["t"] == "ARIMA"        # all missing -> first listed
    _ = F
