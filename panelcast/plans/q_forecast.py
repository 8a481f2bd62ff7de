"""Stage 6 queries: future calendar, naive and recursive forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.dual import SqlRel
from panelcast.operators import ols
from panelcast.operators.forecast import (
    future_calendar,
    lag_index,
    last_rows,
    last_values,
    naive_forecast,
    recursive_linear_forecast,
)
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import rnd
from panelcast.plans.featuresets import KD, OLS_XS, TARGET_D, feature_columns_d, features_d, sql_features_d
from panelcast.plans.q_evaluate import ols_fit

H_FINAL = 12
DP = 6
KEYS_SQL = ", ".join(KD)
MAX_LAG = max(lag_index(x, TARGET_D) or 0 for x in OLS_XS)


@register("future_calendar", ids=("F3", "F4", "A5"), sql=f"""
SELECT {KEYS_SQL}, CAST(s AS INT) AS step, CAST(last_period + to_months(CAST(s AS INTEGER)) AS DATE) AS period,
       strftime(CAST(last_period + to_months(CAST(s AS INTEGER)) AS DATE), '%Y-%m') AS period_label
FROM (SELECT {KEYS_SQL}, max(period) AS last_period FROM ({sql_features_d()}) f GROUP BY {KEYS_SQL}) l,
     generate_series(1, {H_FINAL}) AS g(s)
""")
def q_future_calendar(spark, sf):
    last = features_d(spark, sf).groupBy(*KD).agg(F.max("period").alias("last_period"))
    cal = future_calendar(last, KD, H_FINAL)
    return cal.select(*KD, "step", "period", F.date_format("period", "yyyy-MM").alias("period_label"))


@register("naive_forecast", ids=("R2", "W11"), sql=f"""
SELECT {KEYS_SQL}, CAST(s AS INT) AS step, CAST(last_period + to_months(CAST(s AS INTEGER)) AS DATE) AS period,
       round(yhat, {DP}) AS yhat
FROM (SELECT {KEYS_SQL}, max(period) AS last_period, arg_max({TARGET_D}, period) AS yhat
      FROM ({sql_features_d()}) f WHERE {TARGET_D} IS NOT NULL GROUP BY {KEYS_SQL}) l,
     generate_series(1, {H_FINAL}) AS g(s)
""")
def q_naive_forecast(spark, sf):
    n = naive_forecast(features_d(spark, sf), KD, TARGET_D, H_FINAL)
    return n.select(*KD, "step", "period", rnd("yhat", DP).alias("yhat"))


def forecast_state(spark, sf):
    """One row per series: OLS coefficients, last regressors, target history."""
    feats = features_d(spark, sf)
    fit = ols_fit(spark, sf).df
    coefs = fit.select(*KD, F.col("_obeta_const").alias("coef_const"),
                       *[F.col(f"_obeta{j}").alias(f"coef_{j}") for j in range(len(OLS_XS))])
    last = last_rows(feats, KD, OLS_XS)
    hist = last_values(feats, KD, TARGET_D, MAX_LAG)
    return coefs.join(last, KD).join(hist, KD)


def recursive_ols(spark, sf, h=H_FINAL):
    st = forecast_state(spark, sf)
    return recursive_linear_forecast(st, KD, TARGET_D, OLS_XS, [f"coef_{j}" for j in range(len(OLS_XS))],
                                     "coef_const", h)


def _recursive_sql(h=H_FINAL) -> str:
    fit = ols.fit(SqlRel(sql_features_d()), KD, TARGET_D, OLS_XS, hac_lags=6, complete_cols=feature_columns_d()).sql
    coefs = ", ".join([f"_obeta_const AS coef_const"] + [f"_obeta{j} AS coef_{j}" for j in range(len(OLS_XS))])
    lastx = ", ".join(f"arg_max({x}, period) AS {x}" for x in OLS_XS)
    hist = ", ".join(f"max(CASE WHEN rk = {i} THEN {TARGET_D} END) AS h{i}" for i in range(1, MAX_LAG + 1))
    base = f"""SELECT c.*, l.last_period, {', '.join(f'l.{x}' for x in OLS_XS)}, {', '.join(f'hh.h{i}' for i in range(1, MAX_LAG + 1))}
FROM (SELECT {KEYS_SQL}, {coefs} FROM ({fit}) z) c
JOIN (SELECT {KEYS_SQL}, max(period) AS last_period, {lastx} FROM ({sql_features_d()}) f GROUP BY {KEYS_SQL}) l USING ({KEYS_SQL})
JOIN (SELECT {KEYS_SQL}, {hist} FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS_SQL} ORDER BY period DESC) AS rk
      FROM ({sql_features_d()}) f WHERE {TARGET_D} IS NOT NULL) r GROUP BY {KEYS_SQL}) hh USING ({KEYS_SQL})"""
    q = base
    for s in range(1, h + 1):
        terms = ["coef_const"]
        for j, x in enumerate(OLS_XS):
            n = lag_index(x, TARGET_D)
            if n is None or s == 1:
                v = x
            else:
                v = f"p{s - n}" if s - n >= 1 else f"h{n - s + 1}"
            terms.append(f"coef_{j} * {v}")
        q = f"SELECT *, {' + '.join(terms)} AS p{s} FROM ({q})"
    rows = " UNION ALL ".join(
        f"SELECT {KEYS_SQL}, {s} AS step, CAST(last_period + to_months({s}) AS DATE) AS period, round(p{s}, {DP}) AS yhat FROM rec"
        for s in range(1, h + 1))
    return f"WITH rec AS ({q}) {rows}"


@register("recursive_forecast", ids=("R1", "W11", "W12", "F7", "Q1", "Q2", "B5"), sql=_recursive_sql())
def q_recursive_forecast(spark, sf):
    f = recursive_ols(spark, sf)
    return f.select(*KD, F.col("step").cast("int").alias("step"), "period", rnd("yhat", DP).alias("yhat"))
