"""The extension point of a run: what backtest, fit and forecast need to know of a model.

A forecaster has a ``name``; ``pooled`` tells whether one model serves all
series (it is then fitted on all of them, whichever it wins). ``backtest`` gives
``keys, model, fold_idx, period, y_true, y_pred``, ``fit`` a fitted model on all rows that
``ModelStore`` can keep (a table, one row per series, or a Spark ML model), ``forecast``
the next ``cfg.final_horizon`` periods from it: ``keys, step, period, yhat`` and, if there is a band, ``lo, hi``.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.dual import SparkRel
from panelcast.operators import arma, ols
from panelcast.operators.forecast import lag_index, last_rows, last_values, naive_forecast, recursive_linear_forecast, recursive_model_forecast


class Forecaster(Protocol):
    name: str
    pooled: bool

    def backtest(self, feats: DataFrame, cfg) -> DataFrame: ...

    def fit(self, feats: DataFrame, cfg) -> DataFrame | Model: ...

    def forecast(self, feats: DataFrame, cfg, fitted: DataFrame | Model) -> DataFrame: ...


class Ols:
    name, pooled = "OLS", False

    def backtest(self, feats, cfg):
        return ols.backtest_predictions(SparkRel(feats), cfg.keys, cfg.target, cfg.regressors, cfg.n_folds, cfg.horizon,
                                        complete_cols=cfg.feature_columns(), min_train=cfg.min_train, model=self.name).df

    def statistics(self, feats, cfg):
        """Full-sample fit on the rows with every feature present, every statistic."""
        return ols.fit(SparkRel(feats), cfg.keys, cfg.target, cfg.regressors, hac_lags=cfg.hac_lags,
                       complete_cols=cfg.feature_columns()).df

    def fit(self, feats, cfg):
        return self.statistics(feats, cfg).select(*cfg.keys, F.col("_obeta_const").alias("coef_const"), *[
            F.col(f"_obeta{j}").alias(f"coef_{j}") for j in range(len(cfg.regressors))])

    def forecast(self, feats, cfg, fitted):
        k = cfg.keys
        max_lag = max([lag_index(x, cfg.target) or 0 for x in cfg.regressors] + [1])
        state = fitted.join(last_rows(feats, k, cfg.regressors), k).join(last_values(feats, k, cfg.target, max_lag), k)
        return recursive_linear_forecast(state, k, cfg.target, cfg.regressors, [f"coef_{j}" for j in range(len(cfg.regressors))],
                                         "coef_const", cfg.final_horizon, cfg.freq)


class Arima:
    name, pooled = "ARIMA", False

    def backtest(self, feats, cfg):
        return arma.backtest_predictions(SparkRel(feats), cfg.keys, cfg.target, cfg.n_folds, cfg.horizon,
                                         complete_cols=cfg.feature_columns(), min_train=cfg.min_train, model=self.name).df

    def fit(self, feats, cfg):
        base = SparkRel(feats).filter(f"{cfg.target} IS NOT NULL")
        return arma.hannan_rissanen(base, cfg.keys, cfg.target, arma.adf(base, cfg.keys, cfg.target)).df

    def forecast(self, feats, cfg, fitted):
        return arma.forecast_rows(SparkRel(fitted), cfg.keys, cfg.final_horizon, freq=cfg.freq).df


class Naive:
    name, pooled = "naive", False

    def backtest(self, feats, cfg):
        return ols.naive_backtest_predictions(SparkRel(feats), cfg.keys, cfg.target, cfg.n_folds, cfg.horizon,
                                              complete_cols=cfg.feature_columns(), min_train=cfg.min_train).df

    def fit(self, feats, cfg):
        return naive_forecast(feats, cfg.keys, cfg.target, 1, cfg.freq).select(*cfg.keys, "yhat")

    def forecast(self, feats, cfg, fitted):
        return naive_forecast(feats, cfg.keys, cfg.target, cfg.final_horizon, cfg.freq)


class GradientBoosting:
    """Pooled boosted trees; the refit searches again on all rows."""
    name, pooled = "GradientBoosting", True

    def backtest(self, feats, cfg):
        from panelcast.operators.trees import fit_predict_folds

        return fit_predict_folds(feats, cfg.keys, cfg.target, cfg.feature_columns(), cfg.n_folds, cfg.horizon, "gbt",
                                 n_trials=cfg.n_trials, cv_splits=cfg.cv_splits, seed=cfg.seed, min_train=cfg.min_train,
                                 model_name=self.name, space=cfg.search_space, parallelism=cfg.parallelism)[0]

    def fit(self, feats, cfg):
        from panelcast.operators import trees

        cols = cfg.feature_columns()
        params = trees.search(feats, cfg.keys, cfg.target, cols, "gbt", cfg.n_trials, cfg.cv_splits, cfg.seed, cfg.search_space,
                              parallelism=cfg.parallelism)
        return trees.fit_full(feats, cfg.keys, cfg.target, cols, params, "gbt", cfg.seed)

    def forecast(self, feats, cfg, fitted):
        from panelcast.operators import trees

        cols = cfg.feature_columns()
        state = trees.forecast_state(feats, cfg.keys, cfg.target, cols, cfg.max_lag)
        return recursive_model_forecast(state, cfg.keys, cfg.target, [*cols, trees.SERIES_LEVEL], fitted, cfg.final_horizon, cfg.freq)


class Sequence:
    """Pooled window regressor, stopped by a chronological validation tail."""
    name, pooled = "sequence", True

    def backtest(self, feats, cfg):
        from panelcast.operators.sequence import sequence_backtest

        return sequence_backtest(feats, cfg.keys, cfg.target, cfg.feature_columns(), cfg.n_folds, cfg.horizon, cfg.lookback,
                                 max_iter=cfg.sequence_rounds, seed=cfg.seed, min_train=cfg.min_train, parallelism=cfg.parallelism)

    def fit(self, feats, cfg):
        from panelcast.operators.sequence import sequence_fit

        return sequence_fit(feats, cfg.keys, cfg.target, cfg.feature_columns(), cfg.lookback, max_iter=cfg.sequence_rounds, seed=cfg.seed)

    def forecast(self, feats, cfg, fitted):
        from panelcast.operators.sequence import sequence_forecast

        return sequence_forecast(feats, cfg.keys, cfg.target, cfg.feature_columns(), fitted, cfg.final_horizon, cfg.freq, cfg.lookback)


FORECASTERS: dict[str, Forecaster] = {f.name: f for f in (Ols(), Arima(), GradientBoosting(), Sequence(), Naive())}
