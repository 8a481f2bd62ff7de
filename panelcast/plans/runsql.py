"""The end-to-end run (OLS, ARIMA, last value) as SQL over a feature table, for the oracle."""

from __future__ import annotations

from collections.abc import Sequence

from panelcast.functions.dual import SqlRel
from panelcast.operators import arma, ols
from panelcast.operators.forecast import lag_index

METRICS = """avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
       avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100.0 AS mape"""


def summary_sql(preds: str, keys: Sequence[str]) -> str:
    """Mean, spread and range of each error per series and model over the folds."""
    k = ", ".join(keys)
    stats = ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std, min({m}) AS {m}_min, max({m}) AS {m}_max"
                      for m in ("mae", "rmse", "mape"))
    return f"""SELECT {k}, model, {stats}, count(*) AS n_folds FROM (SELECT {k}, model, fold_idx, {METRICS}
FROM ({preds}) p WHERE isfinite(y_true) AND isfinite(y_pred) GROUP BY {k}, model, fold_idx) m GROUP BY {k}, model"""


def best_sql(summary: str, keys: Sequence[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, model FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY rmse_mean ASC NULLS LAST, mae_mean, mape_mean,
  CASE WHEN model LIKE '%OLS%' THEN 0 WHEN model LIKE '%ARIMA%' THEN 1 ELSE 4 END, model) AS rk FROM ({summary}) s) r WHERE rk = 1"""


def predictions_sql(feats: str, keys, target: str, xs, complete, n_folds: int, horizon: int, adf_lags: int) -> str:
    rel = SqlRel(feats)
    o = ols.backtest_predictions(rel, keys, target, xs, n_folds, horizon, complete_cols=complete)
    a = arma.backtest_predictions(rel, keys, target, n_folds, horizon, complete_cols=complete, adf_lags=adf_lags)
    n = ols.naive_backtest_predictions(rel, keys, target, n_folds, horizon, complete_cols=complete)
    return o.union_all([a, n]).sql


def linear_forecast_sql(feats: str, keys, target: str, xs, complete, h: int, freq: str) -> str:
    """``keys, step, period, yhat``: the fitted line rolled forward, target lags taken from the path."""
    k = ", ".join(keys)
    most = max([lag_index(x, target) or 0 for x in xs] + [1])
    fit = ols.fit(SqlRel(feats), keys, target, xs, complete_cols=complete).sql
    coefs = ", ".join(["_obeta_const AS coef_const"] + [f"_obeta{j} AS coef_{j}" for j in range(len(xs))])
    last = ", ".join(["max(period) AS last_period"] + [f"arg_max({x}, period) AS {x}" for x in xs])
    hist = ", ".join(f"max(CASE WHEN rk = {i} THEN {target} END) AS h{i}" for i in range(1, most + 1))
    q = f"""SELECT * FROM (SELECT {k}, {coefs} FROM ({fit}) z) c JOIN (SELECT {k}, {last} FROM ({feats}) f GROUP BY {k}) l USING ({k})
JOIN (SELECT {k}, {hist} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY period DESC) AS rk FROM ({feats}) f
      WHERE {target} IS NOT NULL) r GROUP BY {k}) hh USING ({k})"""
    for s in range(1, h + 1):
        terms = ["coef_const"]
        for j, x in enumerate(xs):
            n = lag_index(x, target)
            terms.append(f"coef_{j} * " + (x if n is None or s == 1 else f"p{s - n}" if s - n >= 1 else f"h{n - s + 1}"))
        q = f"SELECT *, {' + '.join(terms)} AS p{s} FROM ({q})"
    rows = " UNION ALL ".join(f"SELECT {k}, {s} AS step, {arma.period_text('last_period', s, freq, 'duckdb')} AS period, p{s} AS yhat FROM rec"
                              for s in range(1, h + 1))
    return f"WITH rec AS ({q}) {rows}"


def run_forecast_sql(feats: str, keys, target: str, xs, complete, n_folds: int, horizon: int, h: int, adf_lags: int,
                     freq: str = "month", dp: int = 4) -> str:
    """``keys, step, period, yhat, lo, hi, source`` of a run with these three models."""
    k = ", ".join(keys)
    best = best_sql(summary_sql(predictions_sql(feats, keys, target, xs, complete, n_folds, horizon, adf_lags), keys), keys)
    base = SqlRel(feats).filter(f"{target} IS NOT NULL").share()
    arima = arma.forecast_rows(arma.hannan_rissanen(base, keys, target, arma.adf(base, keys, target, max_lag=adf_lags)), keys, h, freq=freq).sql
    naive = f"""SELECT {k}, CAST(s AS INT) AS step, {arma.period_text('last_period', 's', freq, 'duckdb').replace('(s)', '(CAST(s AS INTEGER))')} AS period, yhat
FROM (SELECT {k}, max(period) AS last_period, arg_max({target}, period) AS yhat FROM ({feats}) f WHERE {target} IS NOT NULL GROUP BY {k}) l,
     generate_series(1, {h}) AS g(s)"""
    none = "CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi"
    return f"""WITH b AS ({best}), o AS ({linear_forecast_sql(feats, keys, target, xs, complete, h, freq)}), a AS ({arima}), n AS ({naive}),
f AS (SELECT {k}, step, period, yhat, {none}, 'OLS' AS source FROM o JOIN b USING ({k}) WHERE model = 'OLS'
  UNION ALL SELECT {k}, step, period, yhat, lo, hi, 'ARIMA' FROM a JOIN b USING ({k}) WHERE model = 'ARIMA'),
w AS (SELECT {k} FROM f WHERE yhat IS NOT NULL AND isfinite(yhat) GROUP BY {k} HAVING count(*) = {h}),
u AS (SELECT f.* FROM f SEMI JOIN w USING ({k}) UNION ALL SELECT {k}, step, period, yhat, {none}, 'last_value' FROM n ANTI JOIN w USING ({k}))
SELECT {k}, CAST(step AS INT) AS step, period, round(yhat, {dp}) AS yhat, round(lo, {dp}) AS lo, round(hi, {dp}) AS hi, source FROM u"""
