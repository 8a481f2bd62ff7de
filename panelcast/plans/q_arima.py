"""Stage 6 queries: ADF decision, Hannan-Rissanen ARMA grid, ARIMA forecast."""

from __future__ import annotations

from panelcast.functions.dual import SparkRel, SqlRel
from panelcast.operators import arma
from panelcast.plans.catalog import register
from panelcast.plans.featuresets import ADF_LAGS, KD, TARGET_D, features_d, sql_features_d

H_FINAL = 12
DP = 6


def _base(rel):
    return rel.filter(f"{TARGET_D} IS NOT NULL").share()


def arima_fit(rel):
    base = _base(rel)
    d = arma.adf(base, KD, TARGET_D, max_lag=ADF_LAGS)
    return arma.hannan_rissanen(base, KD, TARGET_D, d)


def _adf_out(rel):
    a = arma.adf(_base(rel), KD, TARGET_D, max_lag=ADF_LAGS)
    return a.select([(k, k) for k in KD] + [("adf_lag", "adf_lag"), ("adf_stat", f"round(adf_stat, {DP})"),
                                             ("adf_n", "adf_n"), ("d", "d")])


@register("adf_test", ids=("E6",), sql=_adf_out(SqlRel(sql_features_d())).sql)
def q_adf(spark, sf):
    return _adf_out(SparkRel(features_d(spark, sf))).df


_GRID_COLS = ["aic", "bic", "sigma2", "phi1", "phi2", "phi3", "theta1", "theta2", "c"]


def _grid_out(rel):
    f = arima_fit(rel)
    return f.select([(k, k) for k in KD] + [("p", "CAST(p AS INT)"), ("d", "d"), ("q", "CAST(q AS INT)"),
                                             ("n_obs", "n_obs")]
                    + [(c, f"round({c}, {DP - 2})") for c in _GRID_COLS])


@register("arma_grid", ids=("E7", "T5"), sql=_grid_out(SqlRel(sql_features_d())).sql)
def q_arma_grid(spark, sf):
    return _grid_out(SparkRel(features_d(spark, sf))).df


def _fc_out(rel):
    f = arma.forecast_rows(arima_fit(rel), KD, H_FINAL)
    return f.select([(k, k) for k in KD] + [("step", "step"), ("period", "period"),
                                             ("yhat", f"round(yhat, {DP - 2})"), ("lo", f"round(lo, {DP - 2})"),
                                             ("hi", f"round(hi, {DP - 2})")])


@register("arima_forecast", ids=("E8", "E9", "F3"), sql=_fc_out(SqlRel(sql_features_d())).sql)
def q_arima_forecast(spark, sf):
    return _fc_out(SparkRel(features_d(spark, sf))).df


@register("arima_refined", ids=("E7", "E8"))
def q_arima_refined(spark, sf):
    """The fit after the third Hannan-Rissanen step (a recursion over each series: no SQL twin)."""
    base = _base(SparkRel(features_d(spark, sf)))
    fit = arma.refine(arima_fit(SparkRel(features_d(spark, sf))), base, KD, TARGET_D)
    return fit.select([(k, k) for k in KD] + [(c, c) for c in ("p", "d", "q", "refined")]
                      + [(c, f"round({c}, {DP - 2})") for c in ("sigma2", "phi1", "phi2", "phi3", "theta1", "theta2", "c")]).df
