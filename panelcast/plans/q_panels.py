"""The model stages on other panels: panel A (money-scale regressors) and
panel E (daily, 7-period change, three folds of three days)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.dual import SparkRel, SqlRel
from panelcast.operators import arma, ols
from panelcast.operators.features import build_features
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.featuresets import ADF_LAGS, feature_columns, sql_features
from panelcast.plans.sqlbits import filled_sql, rnd

DP = 6
KA, KE = P.PANEL_KEYS["A"], P.PANEL_KEYS["E"]
FA = dict(level_col="v", target="v_yoy", exog=["n", "avg_price"], max_lag=6, windows=[3, 6, 12])
XA = ["n", "avg_price", "v_yoy_lag_1"]
FE = dict(level_col="v", target="v_chg7", exog=[], max_lag=3, windows=[3], change_periods=7)
XE = ["v_chg7_lag_1", "v_chg7_lag_2"]


def _round_preds(rel, keys):
    return rel.select([(k, k) for k in keys] + [("model", "model"), ("fold_idx", "fold_idx"), ("period", "period"),
                                                 ("y_true", f"round(y_true, {DP})"), ("y_pred", f"round(y_pred, {DP})")])


def _a_preds(rel):
    fc = feature_columns(FA["level_col"], FA["target"], FA["exog"], FA["max_lag"], FA["windows"])
    o = ols.backtest_predictions(rel, KA, FA["target"], XA, 5, 6, complete_cols=fc, model="OLS")
    return _round_preds(o, KA)


def features_a(spark, sf):
    a = P.panel_a(spark, sf).withColumn("n", F.col("n").cast("double"))
    return build_features(a, KA, **FA)


_SQL_A_DBL = f"SELECT o_orderpriority, period, v, CAST(n AS DOUBLE) AS n, avg_price FROM ({P.SQL_A}) a"


@register("panel_a_backtest", ids=("B2", "O4", "E1"),
          sql=_a_preds(SqlRel(sql_features(_SQL_A_DBL, KA, **FA))).sql)
def q_panel_a_backtest(spark, sf):
    return _a_preds(SparkRel(features_a(spark, sf))).df


def _e_preds(rel):
    fc = feature_columns(FE["level_col"], FE["target"], FE["exog"], FE["max_lag"], FE["windows"])
    o = ols.backtest_predictions(rel, KE, FE["target"], XE, 3, 3, complete_cols=fc, model="OLS")
    a = arma.backtest_predictions(rel, KE, FE["target"], 3, 3, complete_cols=fc, model="ARIMA", max_p=2,
                                  max_q=1, adf_lags=ADF_LAGS, long_ar=3)
    return _round_preds(o.union_all([a]), KE)


def features_e(spark, sf):
    return build_features(P.panel_e(spark, sf), KE, **FE)


@register("panel_e_daily_backtest", ids=("B1", "B2", "E7", "W1"),
          sql=_e_preds(SqlRel(sql_features(P.SQL_E, KE, **FE))).sql)
def q_panel_e_backtest(spark, sf):
    return _e_preds(SparkRel(features_e(spark, sf))).df


# ---- many series: one per supplier --------------------------------------------------
KS = P.PANEL_KEYS["S"]
FS = dict(level_col="v", target="v_yoy", exog=[], max_lag=6, windows=[3, 6, 12])
XS_S = ["v_yoy_lag_1", "v_yoy_lag_2"]


def _grid_sql(src: str, keys, col: str) -> str:
    k = ", ".join(keys)
    return f"""SELECT g.*, s.{col} FROM (SELECT {k}, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period
FROM (SELECT {k}, min(period) AS lo, max(period) AS hi FROM ({src}) a GROUP BY {k}) b) g LEFT JOIN ({src}) s USING ({k}, period)"""


def _s_preds(rel, with_arima=False):
    fc = feature_columns(FS["level_col"], FS["target"], [], FS["max_lag"], FS["windows"])
    o = ols.backtest_predictions(rel, KS, FS["target"], XS_S, 3, 6, complete_cols=fc, model="OLS")
    if with_arima:
        o = o.union_all([arma.backtest_predictions(rel, KS, FS["target"], 3, 6, complete_cols=fc, adf_lags=ADF_LAGS)])
    return _round_preds(o, KS)


@register("many_series_backtest", ids=("B2", "E1", "J7"), sql=_s_preds(SqlRel(sql_features(_grid_sql(P.SQL_S, KS, "v"), KS, **FS))).sql)
def q_many_series(spark, sf):
    """OLS backtest of one series per supplier, on the regular calendar."""
    return _s_preds(SparkRel(_s_features(spark, sf))).df


def _s_features(spark, sf):
    from panelcast.operators.calendar import fill_spine
    return build_features(fill_spine(P.panel_s(spark, sf), KS), KS, **FS)


@register("many_series_arima", ids=("B2", "E6", "E7", "J7"),
          sql=_s_preds(SqlRel(sql_features(_grid_sql(P.SQL_S, KS, "v"), KS, **FS)), True).sql)
def q_many_series_arima(spark, sf):
    """OLS and ARIMA backtest of the same series."""
    return _s_preds(SparkRel(_s_features(spark, sf)), True).df


# ---- one very long series: windows run segment by segment --------------------------
_DAYS_SQL = "SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS period, sum(o_totalprice) AS v FROM orders GROUP BY 1"
_DAY_GRID = f"""SELECT 0 AS one, g.period, s.v FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS period
FROM (SELECT min(period) AS lo, max(period) AS hi FROM ({_DAYS_SQL}) a) b) g LEFT JOIN ({_DAYS_SQL}) s USING (period)"""
LONG = dict(level_col="v", target="v_chg7", max_lag=3, windows=[3, 7], change_periods=7)
LONG_COLS = ["v", "v_chg7", "v_chg7_lag_1", "v_chg7_lag_3", "v_chg7_roll_mean_7", "v_chg7_roll_std_7"]


@register("long_series_features", ids=("P10", "P11", "P13", "W1", "W2", "W3", "W4", "J7"), sql=f"""
SELECT period, {', '.join(f'round({c}, {DP}) AS {c}' for c in LONG_COLS)}
FROM ({sql_features(filled_sql(_DAY_GRID, "one", "v"), ["one"], **LONG)}) f
""")
def q_long_series(spark, sf):
    """All orders as one daily series without keys: calendar, imputation, change, lags and rolling
    windows in segments of 256 days; the SQL uses plain windows."""
    from panelcast.operators import segments as G
    from panelcast.operators.calendar import resample_agg
    from panelcast.sources.tables import read_table
    days = resample_agg(read_table(spark, sf, "orders"), [], "o_orderdate", {"v": F.sum("o_totalprice")}, "day")
    whole = G.segmented_impute(G.segmented_spine(days, [], "day", 256), [], ["v"], freq="day", size=256)
    f = G.segmented_features(whole, [], freq="day", size=256, **LONG)
    return f.select("period", *[rnd(c, DP).alias(c) for c in LONG_COLS])
