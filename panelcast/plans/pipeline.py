"""End-to-end run over a panel: the reference's ``run`` / ``evaluate`` /
``report`` commands as Spark jobs, one result row per series.

    panel -> numeric values -> date range -> regular calendar -> impute -> validate
          -> features -> backtest every model -> leaderboard -> best model per series
          -> final forecast -> evidence row per series -> markdown text per series

A panel without keys is one series: it gets a constant key on entry, which is
dropped again on exit. The final forecast is chosen per series by joining on its
best model; a series whose forecast is missing or NULL falls back to the last
observed value. A model that fails is left out and listed; the run fails
only when none is left. Only the small per-series tables are joined. Every table is
written once (``store``) and read by the later steps, by ``report`` and by the caller.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException, ArithmeticException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.dual import SparkRel
from panelcast.operators import ols
from panelcast.operators import report as R
from panelcast.operators.calendar import date_range_filter, fill_spine
from panelcast.operators.evaluate import fold_summary, metrics, select_best
from panelcast.operators.features import build_features
from panelcast.operators.forecast import naive_forecast
from panelcast.operators.quality import check_schema, gap_report, impute, validate, validate_strict
from panelcast.operators.segments import segmented_features, segmented_impute, segmented_spine
from panelcast.plans.forecasters import FORECASTERS, Forecaster
from panelcast.plans.store import RunStore, StoredRun
from panelcast.sources.io import coerce_numeric

log = logging.getLogger(__name__)

#: Key of a panel without keys.
ONE_SERIES = "series"
#: Periods a segment where gaps are too long for one task.
LONG_SEGMENT = 4096
#: Label of a period in reports and evidence.
LABEL_FORMAT = {"month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH:00"}


@dataclass
class RunConfig:
    keys: list[str]
    level_col: str
    target: str
    exog: list[str]
    regressors: list[str]
    max_lag: int = 6
    windows: list[int] = field(default_factory=lambda: [3, 6, 12])
    change_periods: int = 12
    use_differencing: bool = False
    n_folds: int = 5
    horizon: int = 6
    final_horizon: int = 12
    hac_lags: int = 6
    models: list[str] = field(default_factory=lambda: ["OLS", "ARIMA"])
    missing_threshold_pct: float = 5.0
    min_obs: int = 36
    data_source: str = "parquet"
    freq: str = "month"
    start: str | None = None
    end: str | None = None
    positive: list[str] | None = None  # default: the level
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    nonnegative: list[str] = field(default_factory=list)
    n_trials: int = 20
    cv_splits: int = 3
    search_space: dict = field(default_factory=dict)  # overrides parts of the reference's space
    lookback: int = 12
    sequence_rounds: int = 200
    seed: int = 42
    min_train: int = 10
    max_gap: int = 1200  # periods; a longer gap is a quality error
    segment: int | None = None  # periods a segment: windows of very long series run segment by segment
    parallelism: int = 4  # fits of a search or of the folds that run side by side

    def feature_columns(self) -> list[str]:
        cols = [self.level_col, *self.exog]
        for c in [self.target, *self.exog]:
            cols += [f"{c}_lag_{k}" for k in range(1, self.max_lag + 1)]
        for c in [self.target, *self.exog]:
            for w in self.windows:
                cols += [f"{c}_roll_mean_{w}", f"{c}_roll_std_{w}"]
        if self.use_differencing:
            cols += [f"{c}_diff1" for c in [*self.exog, self.target]]
        return cols


def given(panel: DataFrame, cfg: RunConfig) -> DataFrame:
    """Numeric values within the date range; ``DataQualityError`` if a column is missing or the period is no date or time."""
    values = [cfg.level_col, *cfg.exog]
    check_schema(panel, [*cfg.keys, *values])
    return date_range_filter(coerce_numeric(panel.select(*cfg.keys, "period", *values), values), cfg.start, cfg.end)


def load(panel: DataFrame, cfg: RunConfig) -> DataFrame:
    """The given rows on the regular calendar, imputed."""
    values = [cfg.level_col, *cfg.exog]
    out = given(panel, cfg)
    if cfg.segment:
        out = segmented_spine(out, cfg.keys, cfg.freq, cfg.segment)
        return segmented_impute(out, cfg.keys, values, cfg.missing_threshold_pct, cfg.freq, cfg.segment)
    out = fill_spine(out, cfg.keys, cfg.freq)
    return impute(out, cfg.keys, values, cfg.missing_threshold_pct)


def prepare(panel: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Cleaned panel and feature table."""
    clean = load(panel, cfg)
    return clean, features(clean, cfg)


def features(clean: DataFrame, cfg: RunConfig) -> DataFrame:
    if cfg.segment:
        return segmented_features(clean, cfg.keys, cfg.level_col, cfg.target, cfg.exog, cfg.max_lag, cfg.windows, cfg.use_differencing,
                                  cfg.change_periods, cfg.freq, cfg.segment)
    return build_features(clean, cfg.keys, cfg.level_col, cfg.target, cfg.exog, max_lag=cfg.max_lag, windows=cfg.windows,
                          use_differencing=cfg.use_differencing, change_periods=cfg.change_periods)


def row_counts(panel: DataFrame, clean: DataFrame, feats: DataFrame, cfg: RunConfig) -> DataFrame:
    """Per series: rows given, on the calendar, with features, complete; and what the features dropped."""
    k = cfg.keys
    complete = F.count_if(F.expr(ols.ok_expr(cfg.target, [c for c in cfg.feature_columns() if c != cfg.target])))
    out = (panel.groupBy(*k).agg(F.count("*").alias("rows_given"))
           .join(clean.groupBy(*k).agg(F.count("*").alias("rows_on_calendar")), k, "left")
           .join(feats.groupBy(*k).agg(F.count("*").alias("rows_with_features"), complete.alias("rows_complete")), k, "left"))
    filled = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("rows_on_calendar", "rows_with_features", "rows_complete")}
    return out.withColumns(filled).withColumn("rows_dropped", F.col("rows_on_calendar") - F.col("rows_with_features"))


#: What a model itself may fail with: bad input, an analysis or arithmetic error. Lost executors, a lost connection and
#: aborted jobs are the run's failures, not a model's, and pass through.
MODEL_ERRORS = (ValueError, ArithmeticError, LookupError, AnalysisException, ArithmeticException, IllegalArgumentException)
_LEFT_OUT = "model string, stage string, reason string"


def _known(cfg: RunConfig, models: Mapping[str, Forecaster] | None) -> list[Forecaster]:
    known = {**FORECASTERS, **(models or {})}
    unknown = [m for m in cfg.models if m not in known]
    if unknown:
        raise ValueError(f"unknown models {unknown}")
    return [known[m] for m in cfg.models]


def backtest(feats: DataFrame, cfg: RunConfig, models: Mapping[str, Forecaster] | None, run_: StoredRun) -> tuple[DataFrame, list]:
    """Predictions of every configured model, written model by model, and those that failed:
    ``(model, stage, reason)``. ``models`` adds to or replaces the known forecasters."""
    parts, left_out = [], []
    for f in _known(cfg, models):
        try:
            preds = f.backtest(feats, cfg).select(*cfg.keys, "model", "fold_idx", "period", "y_true", "y_pred")
            parts.append(run_.write(f"backtest-{f.name}", preds))
        except MODEL_ERRORS as exc:
            left_out.append(_failure(f, "backtest", exc))
    if not parts:
        raise RuntimeError(f"every model failed: {left_out}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, left_out


def _failure(f: Forecaster, stage: str, exc: Exception) -> tuple[str, str, str]:
    reason = f"{type(exc).__name__}: {str(exc).strip().splitlines()[0] if str(exc).strip() else ''}"
    log.warning("model %s failed in the %s: %s", f.name, stage, reason)
    return f.name, stage, reason


def leaderboard(preds: DataFrame, cfg: RunConfig) -> DataFrame:
    fm = metrics(preds, [*cfg.keys, "model", "fold_idx"])
    s = fold_summary(fm, [*cfg.keys, "model"])
    order = F.create_map(*[x for i, m in enumerate(cfg.models) for x in (F.lit(m), F.lit(i))])
    return s.withColumn("model_order", order[F.col("model")])


def final_forecasts(feats: DataFrame, best: DataFrame, cfg: RunConfig, models: Mapping[str, Forecaster] | None,
                    run_: StoredRun, failed: Sequence[str] = ()) -> tuple[DataFrame, list]:
    """Forecast per series from its best model, fitted again on all rows, and the models that failed here.

    A model that wins no series is not fitted; one that is not pooled is fitted on the series it wins.
    The fitted models are kept with the run."""
    k = cfg.keys
    none = F.lit(None).cast("double")
    winners = {r.model for r in best.select("model").distinct().collect()}  # at most one row a model
    picked, left_out = None, []
    for f in _known(cfg, models):
        if f.name not in winners or f.name in failed:
            continue
        mine = best.filter(F.col("model") == f.name).select(*k)
        own = feats if f.pooled else feats.join(mine, on=k, how="left_semi")
        try:
            fitted = run_.models.save(f.name, f.fit(own, cfg))
            part = f.forecast(own, cfg, fitted)
            part = part.select(*k, "step", "period", "yhat", *[(F.col(c) if c in part.columns else none).alias(c) for c in ("lo", "hi")],
                               F.lit(f.name if f.name != "naive" else "last_value").alias("source")).join(mine, on=k, how="left_semi")
            part = run_.write(f"forecast-{f.name}", part)
        except MODEL_ERRORS as exc:
            left_out.append(_failure(f, "forecast", exc))
            continue
        picked = part if picked is None else picked.unionByName(part)
    naive = naive_forecast(feats, k, cfg.target, cfg.final_horizon, cfg.freq).select(
        *k, "step", "period", "yhat", none.alias("lo"), none.alias("hi"), F.lit("last_value").alias("source"))
    if picked is None:
        return naive, left_out
    # a series with a missing or NULL (or infinite) step repeats its last value instead
    usable = F.col("yhat").isNotNull() & ~F.isnan("yhat") & (F.abs("yhat") < float("inf"))
    whole = picked.groupBy(*k).agg(F.count_if(usable).alias("_n")).filter(F.col("_n") == cfg.final_horizon).select(*k)
    return picked.join(whole, on=k, how="left_semi").unionByName(naive.join(whole, on=k, how="left_anti")), left_out


def evidence(spark: SparkSession, panel: DataFrame, feats: DataFrame, board: DataFrame, best: DataFrame,
             fc: DataFrame, fit_rel: DataFrame, cfg: RunConfig, meta: dict) -> DataFrame:
    """One row per series with every number the report prints."""
    k = cfg.keys
    t = cfg.target
    label = LABEL_FORMAT[cfg.freq]
    tstats = feats.groupBy(*k).agg(
        F.date_format(F.min("period"), label).alias("start_date"),
        F.date_format(F.max("period"), label).alias("end_date"),
        F.count(t).cast("bigint").alias("n_obs"),
        F.avg(t).alias("target_mean"), F.stddev_samp(t).alias("target_std"), F.min(t).alias("target_min"),
        F.max(t).alias("target_max"), F.max_by(F.col(t), F.col("period")).alias("target_latest"))
    ex = panel.groupBy(*k).agg(F.count("*").alias("n_periods"), *[a for c in cfg.exog for a in (
        F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
        F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])
    mm = board.groupBy(*k).agg(
        F.map_from_entries(F.collect_list(F.struct("model", F.struct(F.col("mae_mean").alias("mae"),
                                                                     F.col("rmse_mean").alias("rmse"),
                                                                     F.col("mape_mean").alias("mape"))))).alias("model_metrics"),
        F.count(F.lit(1)).cast("bigint").alias("n_models"))
    bst = best.select(*k, F.col("model").alias("best_model"), F.col("rmse_mean").alias("best_rmse"),
                      F.col("mae_mean").alias("best_mae"), F.col("mape_mean").alias("best_mape"))
    coef = ols.coefficient_table(SparkRel(fit_rel), k, cfg.regressors, dp=10).df
    cm = coef.groupBy(*k).agg(*[F.map_from_entries(F.collect_list(F.struct("term", c))).alias(n) for c, n in (
        ("coef", "ols_coefficients"), ("std_err", "ols_std_errors"), ("p_value", "ols_p_values"), ("z_stat", "ols_t_stats"))])
    st = ols.fit_stats_table(SparkRel(fit_rel), k, dp=10).df.select(
        *k, F.col("r2").alias("r_squared"), F.col("adj_r2").alias("adj_r_squared"), F.col("n_obs").alias("nobs"),
        "durbin_watson")
    fcv = fc.groupBy(*k).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("period", label), "yhat"))).alias("forecast_values"),
        F.map_from_entries(F.collect_list(F.struct(F.date_format("period", label), "lo"))).alias("forecast_conf_lower"),
        F.map_from_entries(F.collect_list(F.struct(F.date_format("period", label), "hi"))).alias("forecast_conf_upper"),
        F.date_format(F.min("period"), label).alias("forecast_start"), F.min("source").alias("forecast_source"))
    ev = (tstats.join(ex, k, "left").join(mm, k, "left").join(bst, k, "left").join(cm, k, "left")
                .join(st, k, "left").join(fcv, k, "left"))
    formula = f"{t} ~ " + " + ".join(cfg.regressors)
    return ev.withColumns({
        "data_source": F.lit(cfg.data_source), "n_features": F.lit(len(cfg.feature_columns())).cast("bigint"),
        "n_folds": F.lit(cfg.n_folds).cast("bigint"), "formula": F.lit(formula),
        "hac_lags": F.lit(cfg.hac_lags).cast("bigint"), "forecast_horizon": F.lit(cfg.final_horizon).cast("bigint"),
        "run_id": F.lit(meta["run_id"]), "timestamp": F.lit(meta["timestamp"]),
        "config_hash": F.lit(meta["config_hash"])})


def markdown(ev: DataFrame, coef: DataFrame, fc: DataFrame, board: DataFrame, cfg: RunConfig) -> DataFrame:
    """The report text per series: seven numbered sections."""
    k = cfg.keys
    parts = ev.join(R.comparison_table(board, k), k, "left") \
              .join(R.coefficient_lines(coef, k, ["const", *cfg.regressors]), k, "left") \
              .join(R.forecast_table(fc, k, label=LABEL_FORMAT[cfg.freq]).drop("forecast_start", "forecast_horizon"), k, "left")
    named = [x for x in cfg.exog if x in cfg.regressors]
    parts = parts.join(R.interpretation(coef, k, *named), k, "left") if named else parts.withColumn("interpretation", F.lit(""))
    from panelcast.functions.columns import fmt_fixed as fx
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(R.MISSING))
    key_txt = F.concat_ws(" / ", *[F.col(c).cast("string") for c in k]) if k else F.lit("all")
    summary = F.format_string(
        "Series %s: %s observations from %s to %s (source: %s). The target averaged %s (range %s to %s); "
        "latest %s. Of %s models compared on %s rolling-origin folds, %s had the lowest mean RMSE (%s). "
        "A %s-period forecast follows in section 4.",
        key_txt, text("n_obs"), text("start_date"), text("end_date"), F.col("data_source"),
        fx("target_mean", 2), fx("target_min", 2), fx("target_max", 2), fx("target_latest", 2),
        F.coalesce("n_models", F.lit(0)).cast("string"), F.col("n_folds"), F.coalesce(F.col("best_model"), F.lit(R.MISSING)),
        fx("best_rmse", 4), F.col("forecast_horizon"))
    overview_rows = [F.format_string("| %s | %s | %s | %s | %s |", F.lit(c), fx(f"{c}_mean", 2), fx(f"{c}_std", 2),
                                     fx(f"{c}_min", 2), fx(f"{c}_max", 2)) for c in cfg.exog]
    overview = F.concat_ws("\n", F.lit("| Column | Mean | Std | Min | Max |\n|---|---|---|---|---|"),
                           F.format_string("| %s | %s | %s | %s | %s |", F.lit(cfg.target), fx("target_mean", 2),
                                           fx("target_std", 2), fx("target_min", 2), fx("target_max", 2)),
                           *overview_rows)
    econ = F.concat_ws("\n", F.format_string("OLS with Newey-West standard errors (lags=%s): `%s`",
                                             F.col("hac_lags"), F.col("formula")),
                       F.lit("\n| Variable | Coefficient | Std Error | z | p-value |\n|---|---|---|---|---|"),
                       F.coalesce(F.col("coeff_table"), F.lit(R.EMPTY_ROW_5)),
                       F.format_string("\nR² = %s, adjusted R² = %s, N = %s. Durbin-Watson = %s.",
                                       fx("r_squared", 4), fx("adj_r_squared", 4), text("nobs"), fx("durbin_watson", 3)),
                       F.col("interpretation"))
    fcs = F.concat_ws("\n", F.format_string("Forecast from %s with %s:", text("forecast_start"),
                                            F.coalesce(F.col("forecast_source"), F.lit("last_value"))),
                      F.lit("\n| Period | Forecast |\n|---|---|"),
                      F.coalesce(F.col("forecast_table"), F.lit(R.EMPTY_ROW_2)),
                      F.format_string("\nThe forecast suggests the target will %s over the next %s periods.",
                                      F.coalesce(F.col("trend_description"), F.lit(R.TREND_SHORT)),
                                      F.col("forecast_horizon")))
    risks = F.lit("Forecasts assume historical patterns continue; structural breaks invalidate them. "
                  "Backtest scores use contemporaneous regressors and can be optimistic.")
    repro = F.format_string("| Parameter | Value |\n|---|---|\n| Config hash | `%s` |\n| Run id | %s |\n| Run timestamp | %s |",
                            F.col("config_hash"), F.col("run_id"), F.col("timestamp"))
    sections = [("1. Summary", summary), ("2. Data overview", overview), ("3. Econometric findings", econ),
                ("4. Forecast", fcs), ("5. Model comparison", F.coalesce(F.col("comparison_md"), F.lit(R.NO_METRICS))),
                ("6. Risks and limitations", risks), ("7. Reproducibility", repro)]
    body = F.concat_ws("\n\n---\n\n", *[F.concat(F.lit(f"## {t}\n\n"), s) for t, s in sections])
    doc = F.concat(F.format_string("# Forecast report: %s\n\n> Best model: %s\n\n---\n\n", key_txt,
                                   F.coalesce(F.col("best_model"), F.lit(R.MISSING))), body)
    return parts.select(*k, doc.alias("markdown"))


def _with_key(panel: DataFrame, cfg: RunConfig) -> tuple[DataFrame, RunConfig, bool]:
    if cfg.keys:
        return panel, cfg, False
    return panel.withColumn(ONE_SERIES, F.lit("all")), replace(cfg, keys=[ONE_SERIES]), True


def run(spark: SparkSession, panel: DataFrame, cfg: RunConfig, strict: bool = True,
        models: Mapping[str, Forecaster] | None = None, store: str | None = None) -> dict[str, DataFrame]:
    """Full pipeline; returns the named result tables, each read from the run's files.

    Every table is written once under the run's id (``out["manifest"]`` has it; ``store`` is the root, by default in the
    checkpoint directory), so nothing is cached, lineage is cut at each step, and ``report`` can read the run later.
    ``strict``: errors of the quality report end the run (``DataQualityError``); otherwise they stand in the ``quality`` table.
    A model that fails is left out and listed in ``left_out``."""
    panel, cfg, single = _with_key(panel, cfg)
    meta = R.run_metadata(asdict(cfg))
    run_ = RunStore(spark, store).begin(meta["run_id"])
    gaps = run_.write("gaps", gap_report(given(panel, cfg), cfg.keys, cfg.freq, cfg.max_gap))
    if strict:
        validate_strict(gaps)  # before a bad timestamp is filled with thousands of periods
    elif not cfg.segment and not gaps.isEmpty():
        cfg = replace(cfg, segment=LONG_SEGMENT)  # whoever wants them filled all the same gets them dealt over tasks
    clean = run_.write("clean", load(panel, cfg))
    quality = run_.write("quality", gaps.unionByName(validate(clean, cfg.keys, required=[cfg.level_col, *cfg.exog], min_obs=cfg.min_obs,
                                             positive=[cfg.level_col] if cfg.positive is None else cfg.positive, ranges=cfg.ranges,
                                                              nonnegative=cfg.nonnegative)))
    if strict:
        validate_strict(quality)
    feats = run_.write("features", features(clean, cfg))
    run_.write("row_counts", row_counts(panel, clean, feats, cfg))
    preds, left_out = backtest(feats, cfg, models, run_)
    preds = run_.write("predictions", preds)
    board = run_.write("leaderboard", leaderboard(preds, cfg))
    best = run_.write("best", select_best(board, cfg.keys))
    fc, also = final_forecasts(feats, best, cfg, models, run_, [m for m, _, _ in left_out])
    fc = run_.write("forecast", fc)
    run_.write("left_out", spark.createDataFrame([*left_out, *also], _LEFT_OUT).coalesce(1))
    fit = run_.write("fit", FORECASTERS["OLS"].statistics(feats, cfg))
    run_.write("residuals", R.residuals(feats, fit, cfg.keys, cfg.target, cfg.regressors))
    run_.write("coefficients", ols.coefficient_table(SparkRel(fit), cfg.keys, cfg.regressors, dp=10, robust=cfg.hac_lags > 0).df)
    run_.write("evidence", evidence(spark, clean, feats, board, best, fc, fit, cfg, meta))
    run_.write("markdown", markdown(*(run_.table(t) for t in ("evidence", "coefficients", "forecast", "leaderboard")), cfg))
    run_.finish(meta, asdict(cfg))
    return _tables(run_, single)


def _tables(run_: StoredRun, single: bool) -> dict[str, DataFrame]:
    out = {name: run_.table(name) for name in run_.manifest["tables"]}
    out = {name: df.drop(ONE_SERIES) for name, df in out.items()} if single else out
    row = [tuple(run_.manifest[c] for c in ("run_id", "timestamp", "config_hash", "config"))]
    return out | {"manifest": run_.spark.createDataFrame(row, "run_id string, timestamp string, config_hash string, config string")}


def report(spark: SparkSession, run_id: str, store: str | None = None) -> DataFrame:
    """The report text per series, made anew from what a finished run stored."""
    run_ = RunStore(spark, store).open(run_id)
    given = json.loads(run_.manifest["config"])
    cfg = RunConfig(**{k: {c: tuple(v) for c, v in x.items()} if k == "ranges" else x for k, x in given.items()})
    made = markdown(*(run_.table(t) for t in ("evidence", "coefficients", "forecast", "leaderboard")), cfg)
    return made.drop(ONE_SERIES) if cfg.keys == [ONE_SERIES] else made


def evaluate(spark: SparkSession, panel: DataFrame, cfg: RunConfig, models: Mapping[str, Forecaster] | None = None,
             store: str | None = None) -> DataFrame:
    """Backtest-only entry: the leaderboard (no refit, no report), read from the evaluation's files."""
    panel, cfg, single = _with_key(panel, cfg)
    run_ = RunStore(spark, store).begin(R.run_metadata(asdict(cfg))["run_id"])
    feats = run_.write("features", prepare(panel, cfg)[1])
    board = run_.write("leaderboard", leaderboard(backtest(feats, cfg, models, run_)[0], cfg))
    return board.drop(ONE_SERIES) if single else board
