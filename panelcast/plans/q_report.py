"""Stage 8 queries: descriptive statistics, report tables and text, chart
data, evidence JSON, the end-to-end run."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from panelcast.operators import report as R
from panelcast.operators.evaluate import fold_summary
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.featuresets import ADF_LAGS, FEAT_D, KD, OLS_XS, TARGET_D, feature_columns, feature_columns_d, features_d, sql_features, sql_features_d
from panelcast.plans.q_evaluate import BEST_SQL, SUMMARY_SQL, fold_metrics, ols_fit
from panelcast.plans.q_forecast import _recursive_sql, recursive_ols
from panelcast.plans.runsql import run_forecast_sql
from panelcast.plans.sqlbits import filled_sql, rnd

KEYS_SQL = ", ".join(KD)
DP = 6
_STATS = ("n", "mean", "std", "min", "max", "latest")


def _desc_sql(src: str, col: str) -> str:
    return f"""SELECT {KEYS_SQL}, '{col}' AS "column", count({col}) AS n, round(avg({col}), {DP}) AS mean,
       round(stddev_samp({col}), {DP}) AS std, round(min({col}), {DP}) AS min, round(max({col}), {DP}) AS max,
       round(arg_max({col}, period) FILTER (WHERE {col} IS NOT NULL), {DP}) AS latest
FROM ({src}) s GROUP BY {KEYS_SQL}"""


@register("describe_series", ids=("A4", "A5"), sql=" UNION ALL ".join(
    [_desc_sql(sql_features_d(), TARGET_D)] + [_desc_sql(P.SQL_D, c) for c in FEAT_D["exog"]]))
def q_describe(spark, sf):
    a = R.describe(features_d(spark, sf), KD, [TARGET_D])
    b = R.describe(P.panel_d(spark, sf), KD, FEAT_D["exog"])
    out = a.unionByName(b)
    return out.select(*KD, "column", "n", *[rnd(s, DP).alias(s) for s in _STATS if s != "n"])


@register("series_span", ids=("A5", "F4"), sql=f"""
SELECT {KEYS_SQL}, strftime(min(period), '%Y-%m') AS start_date, strftime(max(period), '%Y-%m') AS end_date,
       count(*) AS n_obs
FROM ({sql_features_d()}) f GROUP BY {KEYS_SQL}
""")
def q_span(spark, sf):
    return R.span(features_d(spark, sf), KD)


def _fx(x: str, d: int) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'N/A' ELSE printf('%.{d}f', {x}) END"


_PREF = ("CASE WHEN model LIKE '%OLS%' THEN 0 WHEN model LIKE '%ARIMA%' THEN 1 "
         "WHEN model LIKE '%GradientBoosting%' THEN 2 WHEN model LIKE '%LSTM%' THEN 3 ELSE 4 END")


@register("comparison_md", ids=("K3", "F11", "F12", "Q6"), sql=f"""
SELECT {KEYS_SQL}, '| Model | MAE | RMSE | MAPE (%) |' || chr(10) || '|-------|-----|------|----------|' || chr(10) ||
       string_agg('| ' || model || ' | ' || {_fx('mae_mean', 4)} || ' | ' || {_fx('rmse_mean', 4)} || ' | ' || {_fx('mape_mean', 2)} || ' |',
                  chr(10) ORDER BY {_PREF}, model) AS comparison_md
FROM ({SUMMARY_SQL}) s GROUP BY {KEYS_SQL}
""")
def q_comparison_md(spark, sf):
    return R.comparison_table(fold_summary(fold_metrics(spark, sf), [*KD, "model"]), KD)


def _coef_sql():
    from panelcast.functions.dual import SqlRel
    from panelcast.operators import ols
    from panelcast.plans.q_evaluate import _ols_sql
    return ols.coefficient_table(_ols_sql(), KD, OLS_XS, dp=10).sql


_TERMS = ["const", *OLS_XS]
_TERM_ORDER = "CASE " + " ".join(f"WHEN term = '{t}' THEN {i}" for i, t in enumerate(_TERMS)) + f" ELSE {len(_TERMS)} END"
_STARS = "CASE WHEN p_value < 0.01 THEN '***' WHEN p_value < 0.05 THEN '**' WHEN p_value < 0.1 THEN '*' ELSE '' END"


@register("ols_table_md", ids=("K2", "F8", "F11", "F12"), sql=f"""
SELECT {KEYS_SQL}, string_agg('| ' || term || ' | ' || {_fx('coef', 4)} || {_STARS} || ' | ' || {_fx('std_err', 4)} || ' | '
                              || {_fx('z_stat', 2)} || ' | ' || {_fx('p_value', 4)} || ' |', chr(10) ORDER BY {_TERM_ORDER}) AS coeff_table
FROM ({_coef_sql()}) c GROUP BY {KEYS_SQL}
""")
def q_ols_table_md(spark, sf):
    from panelcast.functions.dual import SparkRel
    from panelcast.operators import ols
    coef = ols.coefficient_table(SparkRel(ols_fit(spark, sf).df), KD, OLS_XS, dp=10).df
    return R.coefficient_lines(coef, KD, _TERMS)


@register("interpretation", ids=("F10",), sql=f"""
SELECT {KEYS_SQL},
  printf('A one-unit increase in rate1 is associated with a **%.4f** %s in the target (all else equal).', c1,
         CASE WHEN c1 < 0 THEN 'decrease' ELSE 'increase' END) || ' ' ||
  printf('A one-unit increase in rate2 is associated with a **%.4f** %s in the target.', c2,
         CASE WHEN c2 < 0 THEN 'decline' ELSE 'increase' END) AS interpretation
FROM (SELECT {KEYS_SQL}, coalesce(max(CASE WHEN term = 'rate1' THEN coef END), 0.0) AS c1,
             coalesce(max(CASE WHEN term = 'rate2' THEN coef END), 0.0) AS c2
      FROM ({_coef_sql()}) c GROUP BY {KEYS_SQL}) x
""")
def q_interpretation(spark, sf):
    from panelcast.functions.dual import SparkRel
    from panelcast.operators import ols
    coef = ols.coefficient_table(SparkRel(ols_fit(spark, sf).df), KD, OLS_XS, dp=10).df
    return R.interpretation(coef, KD, "rate1", "rate2")


@register("forecast_md", ids=("T3", "F9", "F12", "K4"), sql=f"""
WITH f AS ({_recursive_sql()})
SELECT {KEYS_SQL},
  string_agg(CASE WHEN step <= 12 THEN '| ' || strftime(period, '%Y-%m') || ' | ' || {_fx('yhat', 2)} || ' |' END, chr(10) ORDER BY step) AS forecast_table,
  strftime(min(period), '%Y-%m') AS forecast_start,
  CASE WHEN count(*) < 2 THEN '{R.TREND_SHORT}'
       WHEN arg_max(yhat, step) > arg_min(yhat, step) + {R.TREND_BAND} THEN '{R.TREND_UP}'
       WHEN arg_max(yhat, step) < arg_min(yhat, step) - {R.TREND_BAND} THEN '{R.TREND_DOWN}'
       ELSE '{R.TREND_FLAT}' END AS trend_description,
  count(*) AS forecast_horizon
FROM f GROUP BY {KEYS_SQL}
""")
def q_forecast_md(spark, sf):
    f = recursive_ols(spark, sf).withColumn("yhat", rnd("yhat", DP))
    return R.forecast_table(f, KD)


@register("chart_tail36", ids=("W9", "K6"), sql=f"""
WITH h AS (SELECT {KEYS_SQL}, period, {TARGET_D} AS y FROM ({sql_features_d()}) f
           QUALIFY row_number() OVER (PARTITION BY {KEYS_SQL} ORDER BY period DESC) <= 36),
fc AS ({_recursive_sql()}),
u AS (SELECT {KEYS_SQL}, 'forecast' AS chart, 'history' AS series, period AS x, round(y, {DP}) AS y FROM h
      UNION ALL SELECT {KEYS_SQL}, 'forecast', 'forecast', period, yhat FROM fc)
SELECT * FROM u UNION ALL
SELECT DISTINCT {KEYS_SQL}, 'forecast', 'reference', x, 2.0 FROM u
""")
def q_chart_tail36(spark, sf):
    hist = features_d(spark, sf).withColumn(TARGET_D, rnd(TARGET_D, DP))
    fc = recursive_ols(spark, sf).withColumn("yhat", rnd("yhat", DP))
    c = R.chart_data(hist, fc, KD, TARGET_D, 36, 2.0)
    return c.select(*KD, "chart", "series", "x", "y")


@register("metric_bars", ids=("K6",), sql=f"""
SELECT {KEYS_SQL}, 'model_comparison' AS chart, m AS series, model, round(v, {DP}) AS value
FROM (SELECT {KEYS_SQL}, model, 'mae' AS m, mae_mean AS v FROM ({SUMMARY_SQL}) a
      UNION ALL SELECT {KEYS_SQL}, model, 'rmse', rmse_mean FROM ({SUMMARY_SQL}) b
      UNION ALL SELECT {KEYS_SQL}, model, 'mape', mape_mean FROM ({SUMMARY_SQL}) c) t
""")
def q_metric_bars(spark, sf):
    b = R.metric_bars(fold_summary(fold_metrics(spark, sf), [*KD, "model"]), KD)
    return b.withColumn("value", rnd("value", DP))


# ---- end-to-end --------------------------------------------------------------
def run_cfg():
    from panelcast.plans.pipeline import RunConfig
    return RunConfig(keys=KD, level_col="level", target=TARGET_D, exog=["rate1", "rate2"], regressors=OLS_XS,
                     models=["OLS", "ARIMA", "naive"], data_source="lineitem panel")


_RUN_OF: dict[tuple[str, str], str] = {}


def run_panel_d(spark, sf):
    """The run on panel D, made once per application and table folder; later queries read its files."""
    from panelcast.plans.pipeline import run
    from panelcast.plans.store import RunStore

    of = (spark.sparkContext.applicationId, sf)
    try:
        return RunStore(spark).open(_RUN_OF[of])
    except KeyError:
        _RUN_OF[of] = run(spark, P.panel_d(spark, sf), run_cfg())["manifest"].first().run_id
        return RunStore(spark).open(_RUN_OF[of])


def _forecast_out(f, keys):
    return f.select(*keys, F.col("step").cast("int").alias("step"), "period", rnd("yhat", 4).alias("yhat"),
                    rnd("lo", 4).alias("lo"), rnd("hi", 4).alias("hi"), "source")


@register("pipeline_forecast", ids=("B3", "B5", "R1", "R2", "T1"), sql=run_forecast_sql(
    sql_features_d(), KD, TARGET_D, OLS_XS, feature_columns_d(), 5, 6, 12, ADF_LAGS))
def q_pipeline_forecast(spark, sf):
    return _forecast_out(run_panel_d(spark, sf).table("forecast"), KD)


@register("evidence_json", ids=("K1", "K2", "S5", "F14", "F15", "F16", "F17", "Q7"))
def q_evidence_json(spark, sf):
    return R.to_json_rows(run_panel_d(spark, sf).table("evidence"), KD)


@register("evidence_fields", ids=("K1", "S5", "S6", "F14", "F15"), sql=f"""
SELECT {KEYS_SQL}, strftime(min(period), '%Y-%m') AS start_date, strftime(max(period), '%Y-%m') AS end_date, count({TARGET_D}) AS n_obs,
       round(avg({TARGET_D}), {DP}) AS target_mean, round(stddev_samp({TARGET_D}), {DP}) AS target_std, round(min({TARGET_D}), {DP}) AS target_min,
       round(max({TARGET_D}), {DP}) AS target_max, round(arg_max({TARGET_D}, period), {DP}) AS target_latest, any_value(best_model) AS best_model,
       round(any_value(best_rmse), {DP}) AS best_rmse, CAST({len(feature_columns_d())} AS BIGINT) AS n_features, CAST(3 AS BIGINT) AS n_models,
       CAST(5 AS BIGINT) AS n_folds, CAST(12 AS BIGINT) AS forecast_horizon, strftime(CAST(max(period) + to_months(1) AS DATE), '%Y-%m') AS forecast_start,
       'lineitem panel' AS data_source, '{TARGET_D} ~ {" + ".join(OLS_XS)}' AS formula, CAST(6 AS BIGINT) AS hac_lags
FROM ({sql_features_d()}) f LEFT JOIN ({BEST_SQL}) b USING ({KEYS_SQL}) GROUP BY {KEYS_SQL}
""")
def q_evidence_fields(spark, sf):
    """The evidence's deterministic fields, written as JSON lines and read back from them."""
    from panelcast.session import ensure_checkpoint_dir

    fields = ["start_date", "end_date", "n_obs", "target_mean", "target_std", "target_min", "target_max", "target_latest", "best_model",
              "best_rmse", "n_features", "n_models", "n_folds", "forecast_horizon", "forecast_start", "data_source", "formula", "hac_lags"]
    ev = run_panel_d(spark, sf).table("evidence").select(*KD, *fields)
    path = f"{ensure_checkpoint_dir(spark)}/evidence-{uuid.uuid4().hex}"
    R.write_json(ev, path)
    back = R.read_json(spark, path, ev.schema)
    return back.withColumns({c: rnd(c, DP) for c in fields if c.startswith(("target_", "best_rmse"))})


@register("report_markdown", ids=("K4", "K5", "S7", "F11", "F12"))
def q_report_markdown(spark, sf):
    return run_panel_d(spark, sf).table("markdown")


@register("stored_report", ids=("S6", "S7", "K5"))
def q_stored_report(spark, sf):
    """The report made anew from the stored evidence of a finished run."""
    from panelcast.plans.pipeline import report

    return report(spark, run_panel_d(spark, sf).manifest["run_id"])


_BOARD_COLS = [f"{m}_{st}" for m in ("mae", "rmse", "mape") for st in ("mean", "std", "min", "max")]


@register("evaluate_leaderboard", ids=("B4", "A10", "U2"), sql=f"""
SELECT {KEYS_SQL}, model, {', '.join(f'round({c}, {DP}) AS {c}' for c in _BOARD_COLS)}, n_folds,
       CASE model WHEN 'OLS' THEN 0 WHEN 'ARIMA' THEN 1 WHEN 'naive' THEN 2 END AS model_order
FROM ({SUMMARY_SQL}) s
""")
def q_evaluate(spark, sf):
    """The evaluate entry: impute, features, backtest OLS / ARIMA / naive,
    summary per model (no refit, no report)."""
    from panelcast.plans.pipeline import evaluate
    b = evaluate(spark, P.panel_d(spark, sf), run_cfg())
    return b.select(*KD, "model", *[rnd(c, DP).alias(c) for c in _BOARD_COLS], "n_folds", "model_order")


# ---- run on other input: gaps, one series without keys, days --------------------
KC = P.PANEL_KEYS["C"]
KC_SQL = ", ".join(KC)
CHANGE_C = "v_yoy"


def gappy_cfg():
    from panelcast.plans.pipeline import RunConfig
    return RunConfig(keys=KC, level_col="v", target=CHANGE_C, exog=[], regressors=[f"{CHANGE_C}_lag_1"], models=["naive"],
                     data_source="orders panel")


@register("run_gappy_panel_c", ids=("J7", "P13", "P14", "W1"), sql=f"""
SELECT {KC_SQL}, period, round({CHANGE_C}, {DP}) AS {CHANGE_C}, round({CHANGE_C}_lag_1, {DP}) AS {CHANGE_C}_lag_1,
       round({CHANGE_C}_roll_mean_12, {DP}) AS {CHANGE_C}_roll_mean_12
FROM ({sql_features(filled_sql(P.SQL_C_SPINE, KC_SQL, 'v'), KC, 'v', CHANGE_C)}) f
""")
def q_run_gappy(spark, sf):
    """The run's load stage and features on 125 series of which about a quarter of the months are empty."""
    from panelcast.plans.pipeline import prepare
    f = prepare(P.panel_c(spark, sf), gappy_cfg())[1]
    return f.select(*KC, "period", *[rnd(c, DP).alias(c) for c in (
        CHANGE_C, f"{CHANGE_C}_lag_1", f"{CHANGE_C}_roll_mean_12")])


@register("run_gappy_forecast", ids=("J7", "P13", "B3", "B5"), sql=run_forecast_sql(
    sql_features(filled_sql(P.SQL_C_SPINE, KC_SQL, "v"), KC, "v", CHANGE_C), KC, CHANGE_C, [f"{CHANGE_C}_lag_1"],
    feature_columns("v", CHANGE_C), 5, 6, 12, ADF_LAGS))
def q_run_gappy_forecast(spark, sf):
    """The whole run with OLS, ARIMA and last value on the gappy panel; short series only warn."""
    from panelcast.plans.pipeline import run
    cfg = replace(gappy_cfg(), models=["OLS", "ARIMA", "naive"])
    return _forecast_out(run(spark, P.panel_c(spark, sf), cfg, strict=False)["forecast"], KC)


_ONE_SQL = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum(o_totalprice) AS v FROM orders GROUP BY 1"
_ONE_FEATS = sql_features(f"SELECT 'all' AS series, o.* FROM ({_ONE_SQL}) o", ["series"], "v", CHANGE_C)


@register("run_single_series", ids=("B5", "R2", "K1"), sql=f"""SELECT * EXCLUDE (series) FROM ({run_forecast_sql(
    _ONE_FEATS, ["series"], CHANGE_C, [f"{CHANGE_C}_lag_1", f"{CHANGE_C}_lag_2"], feature_columns("v", CHANGE_C), 5, 6, 12, ADF_LAGS)}) f""")
def q_run_single(spark, sf):
    """A panel without keys: all orders as one series, end to end with OLS, ARIMA and last value."""
    from panelcast.operators.calendar import resample_agg
    from panelcast.plans.pipeline import RunConfig, run
    from panelcast.sources.tables import read_table
    one = resample_agg(read_table(spark, sf, "orders"), [], "o_orderdate", {"v": F.sum("o_totalprice")})
    cfg = RunConfig(keys=[], level_col="v", target=CHANGE_C, exog=[], regressors=[f"{CHANGE_C}_lag_1", f"{CHANGE_C}_lag_2"],
                    models=["OLS", "ARIMA", "naive"])
    return _forecast_out(run(spark, one, cfg)["forecast"], [])


@register("run_daily_panel_e", ids=("F2", "F3", "K1", "B5"), sql=f"""
SELECT f.*, strftime(min(period) OVER (PARTITION BY event_type), '%Y-%m-%d') AS forecast_start FROM ({run_forecast_sql(
    sql_features(P.SQL_E, ['event_type'], 'v', 'v_chg7', max_lag=3, windows=(3,), change_periods=7), ['event_type'], 'v_chg7',
    ['v_chg7_lag_1'], feature_columns('v', 'v_chg7', max_lag=3, windows=(3,)), 2, 3, 5, ADF_LAGS, freq='day')}) f
""")
def q_run_daily(spark, sf):
    """Daily series end to end with OLS, ARIMA and last value, evidence included."""
    from panelcast.plans.pipeline import RunConfig, run
    cfg = RunConfig(keys=["event_type"], level_col="v", target="v_chg7", exog=[], regressors=["v_chg7_lag_1"], max_lag=3, windows=[3],
                    change_periods=7, n_folds=2, horizon=3, final_horizon=5, models=["OLS", "ARIMA", "naive"], freq="day", min_obs=14, positive=[])
    out = run(spark, P.panel_e(spark, sf), cfg)
    f = out["forecast"].join(out["evidence"].select("event_type", "forecast_start"), "event_type")
    return _forecast_out(f, ["event_type"]).join(f.select("event_type", "step", "forecast_start"), ["event_type", "step"])


#: Size of the registered run with every model (an argument; the default is the reference's 20 trials x 3 splits).
ALL_MODELS = dict(models=["OLS", "ARIMA", "GradientBoosting", "sequence", "naive"], n_folds=2, n_trials=2, cv_splits=2,
                  search_space={"n_estimators": [10], "max_depth": [2, 3]}, sequence_rounds=25)


@register("run_all_models", ids=("B3", "B4", "B5", "E10", "E16", "T6"))
def q_run_all(spark, sf):
    """Every model from the leaderboard to the final forecast; the size of the search stands in the result."""
    from panelcast.plans.pipeline import run
    out = run(spark, P.panel_d(spark, sf), replace(run_cfg(), **ALL_MODELS))
    f = out["forecast"].join(out["best"].select(*KD, F.col("rmse_mean").alias("best_rmse")), KD)
    size = {"n_folds": "n_folds", "search_trials": "n_trials", "search_splits": "cv_splits", "most_rounds": "sequence_rounds"}
    return f.select(*KD, "step", "period", rnd("yhat", 4).alias("yhat"), "source", rnd("best_rmse", 4).alias("best_rmse"),
                    *[F.lit(ALL_MODELS[c]).alias(n) for n, c in size.items()])


@register("row_counts", ids=("A14",), sql=f"""
SELECT g.*, CAST(coalesce(n, 0) AS BIGINT) AS rows_with_features, CAST(rows_on_calendar - coalesce(n, 0) AS BIGINT) AS rows_dropped
FROM (SELECT {KC_SQL}, CAST(count(v) AS BIGINT) AS rows_given, CAST(count(*) AS BIGINT) AS rows_on_calendar FROM ({P.SQL_C_SPINE}) s GROUP BY {KC_SQL}) g
LEFT JOIN (SELECT {KC_SQL}, count(*) AS n FROM ({sql_features(filled_sql(P.SQL_C_SPINE, KC_SQL, 'v'), KC, 'v', CHANGE_C)}) f GROUP BY {KC_SQL}) f
USING ({KC_SQL})
""")
def q_row_counts(spark, sf):
    from panelcast.plans.pipeline import prepare, row_counts
    panel, cfg = P.panel_c(spark, sf), gappy_cfg()
    return row_counts(panel, *prepare(panel, cfg), cfg).drop("rows_complete")



# ---- report rows with a SQL twin: band of the chart, history panel, fixed evidence ------------------
def _arima_sql() -> str:
    from panelcast.functions.dual import SqlRel
    from panelcast.plans.q_arima import _fc_out
    return _fc_out(SqlRel(sql_features_d())).sql


@register("forecast_band_chart", ids=("K6", "E9"), sql=f"SELECT {KEYS_SQL}, period AS x, yhat AS y, lo, hi FROM ({_arima_sql()}) f")
def q_forecast_band(spark, sf):
    from panelcast.plans.q_arima import q_arima_forecast
    c = R.chart_data(features_d(spark, sf), q_arima_forecast(spark, sf), KD, TARGET_D, 36, None)
    return c.filter("series = 'forecast'").select(*KD, "x", "y", "lo", "hi")


@register("history_chart", ids=("K6",), sql=" UNION ALL ".join(
    f"SELECT {KEYS_SQL}, 'history' AS chart, '{c}' AS series, period AS x, round({c}, {DP}) AS y FROM ({sql_features_d()}) f"
    for c in (TARGET_D, *FEAT_D["exog"])))
def q_history_chart(spark, sf):
    h = R.history_panels(features_d(spark, sf), KD, [TARGET_D, *FEAT_D["exog"]])
    return h.withColumn("y", rnd("y", DP))
