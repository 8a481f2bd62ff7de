"""Stage 4/5 queries: folds, backtests, metrics, summaries, model choice,
OLS fit tables. Input: the panel-D feature table (6 series)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.dual import SparkRel, SqlRel
from panelcast.operators import arma, ols
from panelcast.operators.evaluate import fold_rows, fold_summary, folds, metrics, select_best
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import rnd
from panelcast.plans.featuresets import ADF_LAGS, KD, OLS_XS, TARGET_D, feature_columns_d, features_d, sql_features_d

K_FOLDS, H = 5, 6
DP = 6
KEYS_SQL = ", ".join(KD)


def _pos_sql(src: str) -> str:
    return f"""SELECT *, CASE WHEN pos >= n_rows - {K_FOLDS * H}
                   THEN {K_FOLDS} - CAST(ceil((n_rows - pos) / {float(H)}) AS BIGINT) END AS fold_idx
FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS_SQL} ORDER BY period) - 1 AS pos,
             count(*) OVER (PARTITION BY {KEYS_SQL}) AS n_rows FROM ({src})) p
WHERE n_rows >= {(K_FOLDS + 1) * H}"""


@register("folds", ids=("B1", "W6", "T4"), sql=f"""
SELECT {KEYS_SQL}, CAST(fold_idx AS INT) AS fold_idx, any_value(n_rows) AS n_rows, CAST(0 AS BIGINT) AS train_start,
       min(pos) AS train_end, min(pos) AS test_start, max(pos) + 1 AS test_end,
       any_value(first_period) AS train_start_period, min(period) AS test_start_period, max(period) AS test_end_period
FROM (SELECT *, min(period) OVER (PARTITION BY {KEYS_SQL}) AS first_period FROM ({_pos_sql(sql_features_d())}) q) r
WHERE fold_idx IS NOT NULL GROUP BY {KEYS_SQL}, fold_idx
""")
def q_folds(spark, sf):
    return folds(features_d(spark, sf), KD, K_FOLDS, H)


@register("fold_rows", ids=("J6", "B1"), sql=f"""
SELECT {KEYS_SQL}, period, CAST(f AS INT) AS fold_idx,
       CASE WHEN pos >= n_rows - ({K_FOLDS} - f) * {H} THEN 'test' ELSE 'train' END AS role
FROM (SELECT *, unnest(generate_series(0, {K_FOLDS - 1})) AS f FROM ({_pos_sql(sql_features_d())}) q) r
WHERE pos < n_rows - ({K_FOLDS} - f - 1) * {H}
""")
def q_fold_rows(spark, sf):
    return fold_rows(features_d(spark, sf), KD, K_FOLDS, H).select(*KD, "period", "fold_idx", "role")


def _pred_rel(rel):
    feats = feature_columns_d()
    o = ols.backtest_predictions(rel, KD, TARGET_D, OLS_XS, K_FOLDS, H, complete_cols=feats, model="OLS")
    a = arma.backtest_predictions(rel, KD, TARGET_D, K_FOLDS, H, complete_cols=feats, model="ARIMA",
                                  adf_lags=ADF_LAGS)
    n = ols.naive_backtest_predictions(rel, KD, TARGET_D, K_FOLDS, H, complete_cols=feats, model="naive")
    u = o.union_all([a, n])
    return u.df if isinstance(rel, SparkRel) else u.sql


def predictions(spark, sf):
    """Backtest predictions of every model on the panel-D features."""
    return _pred_rel(SparkRel(features_d(spark, sf)))


PRED_SQL = _pred_rel(SqlRel(sql_features_d()))

_METRICS_SQL = """avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
       avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100.0 AS mape"""
FOLD_METRICS_SQL = f"""SELECT {KEYS_SQL}, model, fold_idx, {_METRICS_SQL}
FROM ({PRED_SQL}) p WHERE isfinite(y_true) AND isfinite(y_pred) GROUP BY {KEYS_SQL}, model, fold_idx"""


@register("backtest_predictions", ids=("B2", "B3", "U2", "J5", "E4", "O4", "Q3", "Q12"), sql=f"""
SELECT {KEYS_SQL}, model, fold_idx, period, round(y_true, {DP}) AS y_true, round(y_pred, {DP}) AS y_pred
FROM ({PRED_SQL}) p
""")
def q_backtest_predictions(spark, sf):
    p = predictions(spark, sf)
    return p.select(*KD, "model", "fold_idx", "period", rnd("y_true", DP).alias("y_true"),
                    rnd("y_pred", DP).alias("y_pred"))


def fold_metrics(spark, sf):
    return metrics(predictions(spark, sf), [*KD, "model", "fold_idx"])


@register("fold_metrics", ids=("A6", "A7", "A8", "A9", "P9"), sql=f"""
SELECT {KEYS_SQL}, model, fold_idx, round(mae, {DP}) AS mae, round(rmse, {DP}) AS rmse, round(mape, {DP}) AS mape
FROM ({FOLD_METRICS_SQL}) m
""")
def q_fold_metrics(spark, sf):
    m = fold_metrics(spark, sf)
    return m.select(*KD, "model", "fold_idx", *[rnd(c, DP).alias(c) for c in ("mae", "rmse", "mape")])


SUMMARY_SQL = f"""SELECT {KEYS_SQL}, model,
  {', '.join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std, min({m}) AS {m}_min, max({m}) AS {m}_max" for m in ("mae", "rmse", "mape"))},
  count(*) AS n_folds
FROM ({FOLD_METRICS_SQL}) m GROUP BY {KEYS_SQL}, model"""
_SUM_COLS = [f"{m}_{s}" for m in ("mae", "rmse", "mape") for s in ("mean", "std", "min", "max")]


@register("fold_summary", ids=("A10", "Q11"), sql=f"""
SELECT {KEYS_SQL}, model, {', '.join(f'round({c}, {DP}) AS {c}' for c in _SUM_COLS)}, n_folds FROM ({SUMMARY_SQL}) s
""")
def q_fold_summary(spark, sf):
    s = fold_summary(fold_metrics(spark, sf), [*KD, "model"])
    return s.select(*KD, "model", *[rnd(c, DP).alias(c) for c in _SUM_COLS], "n_folds")


BEST_SQL = f"""
SELECT {KEYS_SQL}, model AS best_model, round(rmse_mean, {DP}) AS best_rmse
FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS_SQL} ORDER BY rmse_mean ASC NULLS LAST, mae_mean, mape_mean,
             CASE WHEN model LIKE '%OLS%' THEN 0 WHEN model LIKE '%ARIMA%' THEN 1
                  WHEN model LIKE '%GradientBoosting%' THEN 2 WHEN model LIKE '%LSTM%' THEN 3 ELSE 4 END, model) AS rk
      FROM ({SUMMARY_SQL}) s) r WHERE rk = 1
"""


@register("best_model", ids=("T1", "F13", "Q8"), sql=BEST_SQL)
def q_best_model(spark, sf):
    s = fold_summary(fold_metrics(spark, sf), [*KD, "model"])
    b = select_best(s, KD, list_order=None)
    return b.select(*KD, F.col("model").alias("best_model"), rnd("rmse_mean", DP).alias("best_rmse"))


# ---- full-sample OLS --------------------------------------------------------
def ols_fit(spark, sf, xs=OLS_XS, hac_lags=6):
    return ols.fit(SparkRel(features_d(spark, sf)), KD, TARGET_D, xs, hac_lags=hac_lags, complete_cols=feature_columns_d())


def _ols_sql(xs=OLS_XS, hac_lags=6):
    return ols.fit(SqlRel(sql_features_d()), KD, TARGET_D, xs, hac_lags=hac_lags, complete_cols=feature_columns_d())


@register("ols_hac", ids=("E1", "E2", "E3", "E5", "F8", "A11", "W10"), sql=ols.coefficient_table(_ols_sql(), KD, OLS_XS).sql)
def q_ols_hac(spark, sf):
    return ols.coefficient_table(ols_fit(spark, sf), KD, OLS_XS).df


@register("ols_classic", ids=("E1", "E3", "E5"), sql=ols.coefficient_table(_ols_sql(hac_lags=0), KD, OLS_XS, robust=False).sql)
def q_ols_classic(spark, sf):
    return ols.coefficient_table(ols_fit(spark, sf, hac_lags=0), KD, OLS_XS, robust=False).df


@register("ols_fit_stats", ids=("A12", "A13", "E5"), sql=ols.fit_stats_table(_ols_sql(), KD).sql)
def q_ols_fit_stats(spark, sf):
    return ols.fit_stats_table(ols_fit(spark, sf), KD).df


@register("ols_simple", ids=("E1",), sql=ols.coefficient_table(_ols_sql(["level_yoy_lag_1"]), KD, ["level_yoy_lag_1"]).sql)
def q_ols_simple(spark, sf):
    return ols.coefficient_table(ols_fit(spark, sf, ["level_yoy_lag_1"]), KD, ["level_yoy_lag_1"]).df
