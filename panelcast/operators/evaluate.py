"""Rolling-origin evaluation: fold assignment, metrics, fold summaries,
model selection.

Folds are arithmetic on a row's position, never a Python loop: with ``n``
rows in a series, fold f (0 = earliest) tests positions
``[n-(K-f)h, n-(K-f-1)h)`` and trains on ``[0, n-(K-f)h)``. A row belongs to
the folds ``f >= f_min(pos)``; ``explode(sequence(f_min, K-1))`` produces
the (row, fold) pairs in place, with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import is_finite
from panelcast.operators.calendar import PERIOD, _keys, series_window

EPS = 1e-8  # fixed value: safe MAPE denominator floor
METRICS = ("mae", "rmse", "mape")


def add_positions(df: DataFrame, keys, period_col: str = PERIOD) -> DataFrame:
    """0-based position ``pos`` and series length ``n_rows`` per series."""
    k = _keys(keys)
    w = series_window(k, period_col)
    whole = Window.partitionBy(*k) if k else Window.partitionBy()
    return df.withColumns({"pos": (F.row_number().over(w) - 1).cast("bigint"),
                           "n_rows": F.count(F.lit(1)).over(whole).cast("bigint")})


def test_fold(pos: Column, n: Column, n_folds: int, horizon: int) -> Column:
    """Index of the fold whose test window holds ``pos`` (NULL if train-only)."""
    k, h = int(n_folds), int(horizon)
    first_test = n - F.lit(k * h)
    f = F.lit(k) - F.ceil((n - pos) / F.lit(float(h))).cast("bigint")
    return F.when(pos >= first_test, f)


def enough_rows(n: Column, n_folds: int, horizon: int) -> Column:
    """The reference's minimum: n >= (K + 1) * h."""
    return n >= F.lit((int(n_folds) + 1) * int(horizon))


def folds(df: DataFrame, keys, n_folds: int = 5, horizon: int = 6,
          period_col: str = PERIOD) -> DataFrame:
    """One row per (series, fold): positions and dates of the train/test windows.

    Series shorter than (K+1)h get no folds (the reference raises for its
    single series; in a panel the others continue).
    """
    k = _keys(keys)
    K, h = int(n_folds), int(horizon)
    whole = Window.partitionBy(*k) if k else Window.partitionBy()
    pos = add_positions(df.select(*k, period_col), k, period_col)
    pos = pos.filter(enough_rows(F.col("n_rows"), K, h))
    pos = pos.withColumns({"fold_idx": test_fold(F.col("pos"), F.col("n_rows"), K, h),
                           "_first": F.min(period_col).over(whole)})
    test = (pos.filter(F.col("fold_idx").isNotNull())
               .groupBy(*k, "fold_idx")
               .agg(F.min("pos").alias("test_start"), (F.max("pos") + 1).alias("test_end"),
                    F.min(period_col).alias("test_start_period"), F.max(period_col).alias("test_end_period"),
                    F.first("n_rows").alias("n_rows"), F.first("_first").alias("train_start_period")))
    return test.select(*k, F.col("fold_idx").cast("int").alias("fold_idx"), "n_rows",
                       F.lit(0).cast("bigint").alias("train_start"),
                       F.col("test_start").alias("train_end"), "test_start", "test_end",
                       "train_start_period", "test_start_period", "test_end_period")


def fold_rows(df: DataFrame, keys, n_folds: int = 5, horizon: int = 6,
              period_col: str = PERIOD) -> DataFrame:
    """(row, fold) pairs with ``role`` train/test for every fold a row is in.

    Fold f contains positions < n-(K-f-1)h, so a row at ``pos`` is in folds
    ``f_min..K-1`` with ``f_min = max(0, floor(K-1-(n-pos)/h)+1)``.
    """
    k = _keys(keys)
    K, h = int(n_folds), int(horizon)
    pos = add_positions(df, k, period_col).filter(enough_rows(F.col("n_rows"), K, h))
    n, p = F.col("n_rows"), F.col("pos")
    fmin = F.greatest(F.lit(0).cast("bigint"),
                      F.floor(F.lit(K - 1) - (n - p) / F.lit(float(h))).cast("bigint") + 1)
    out = pos.withColumn("fold_idx", F.explode(F.sequence(fmin, F.lit(K - 1).cast("bigint"))))
    test_start = n - (F.lit(K) - F.col("fold_idx")) * F.lit(h)
    return out.withColumn("role", F.when(p >= test_start, "test").otherwise("train")) \
              .withColumn("fold_idx", F.col("fold_idx").cast("int"))


def metric_columns(y: str = "y_true", yhat: str = "y_pred") -> list[Column]:
    """MAE, RMSE, MAPE over pairs where both sides are finite.

    Empty input gives NULL (the reference's NaN). MAPE uses the safe
    denominator max(|y|, 1e-8) and is in percent.
    """
    ok = is_finite(y) & is_finite(yhat)
    err = F.when(ok, F.col(y) - F.col(yhat))
    ay = F.when(ok, F.greatest(F.abs(F.col(y)), F.lit(EPS)))
    return [F.avg(F.abs(err)).alias("mae"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            (F.avg(F.abs(err) / ay) * F.lit(100.0)).alias("mape")]


def metrics(pred: DataFrame, group_cols: Sequence[str], y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    return pred.groupBy(*group_cols).agg(*metric_columns(y, yhat))


def fold_summary(fold_metrics: DataFrame, group_cols: Sequence[str],
                 metric_names: Sequence[str] = METRICS) -> DataFrame:
    """Per group: mean, population std, min, max of each metric over the
    folds where the metric is present (macro average of fold metrics)."""
    aggs = []
    for m in metric_names:
        c = F.col(m)
        aggs += [F.avg(c).alias(f"{m}_mean"), F.stddev_pop(c).alias(f"{m}_std"),
                 F.min(c).alias(f"{m}_min"), F.max(c).alias(f"{m}_max")]
    return fold_metrics.groupBy(*group_cols).agg(*aggs, F.count(F.lit(1)).cast("bigint").alias("n_folds"))


# Model preference used as the last tie-break (lower = preferred),
# matched as substrings of the model name.
MODEL_PREFERENCE = ("OLS", "ARIMA", "GradientBoosting", "LSTM")


def preference_rank(model_col: str = "model", preference: Sequence[str] = MODEL_PREFERENCE) -> Column:
    m = F.col(model_col)
    expr = F.lit(len(preference))
    for i in reversed(range(len(preference))):
        expr = F.when(m.contains(preference[i]), F.lit(i)).otherwise(expr)
    return expr


def select_best(board: DataFrame, keys, model_col: str = "model", list_order: str | None = "model_order",
                preference: Sequence[str] = MODEL_PREFERENCE) -> DataFrame:
    """Best model per series: min (rmse_mean, mae_mean, mape_mean, preference).

    Models with missing RMSE rank after all others; if every model lacks an
    RMSE the first listed (``list_order``) wins. One window over ``keys``.
    """
    k = _keys(keys)
    rm = F.col("rmse_mean")
    ordered = [rm.asc_nulls_last(),
               F.when(rm.isNotNull(), F.col("mae_mean")).asc_nulls_last(),
               F.when(rm.isNotNull(), F.col("mape_mean")).asc_nulls_last(),
               F.when(rm.isNotNull(), preference_rank(model_col, preference)).asc_nulls_last()]
    if list_order and list_order in board.columns:
        ordered.append(F.col(list_order).asc())
    ordered.append(F.col(model_col).asc())
    w = (Window.partitionBy(*k) if k else Window.partitionBy()).orderBy(*ordered)
    return board.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")
