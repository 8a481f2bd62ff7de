"""Sequence-window operators and the window-regression forecaster.

The reference trains a recurrent network on sliding windows. Here the
windows are built with window functions (bounded frames of ``L`` rows, so
an array never grows with the series), flattened to a feature vector and
fitted by pooled boosted trees. A chronological validation tail gives an error
per round: training stops after ``patience`` rounds without gain and keeps the best
round. The neural network itself is not rebuilt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.calendar import PERIOD, _keys, series_window
from panelcast.operators.parallel import side_by_side
from panelcast.session import ensure_checkpoint_dir


def lag_window(cols: Sequence[str], keys, L: int, include_current: bool = False,
               period_col: str = PERIOD) -> Column:
    """Array (oldest first) of ``struct(cols)`` over the previous ``L`` rows
    (``include_current``: rows t-L+1..t)."""
    w = series_window(keys, period_col)
    frame = w.rowsBetween(-(L - 1), 0) if include_current else w.rowsBetween(-L, -1)
    return F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in cols])).over(frame)


def sequence_windows(df: DataFrame, keys, cols: Sequence[str], target: str, L: int,
                     period_col: str = PERIOD) -> DataFrame:
    """Training samples: window of rows t-L..t-1, label = target at t.

    Only complete windows (exactly ``L`` rows) are kept: a series of T rows
    gives T - L samples.
    """
    k = _keys(keys)
    out = df.select(*k, period_col, lag_window(cols, k, L, False, period_col).alias("window"),
                    F.col(target).cast("double").alias("label"))
    return out.filter(F.size("window") == L)


def scoring_windows(df: DataFrame, keys, cols: Sequence[str], L: int, period_col: str = PERIOD) -> DataFrame:
    """Windows of rows t-L+1..t, left-padded with all-zero rows to length L."""
    k = _keys(keys)
    zero = F.struct(*[F.lit(0.0).alias(c) for c in cols])
    win = lag_window(cols, k, L, True, period_col)
    pad = F.array_repeat(zero, F.lit(L) - F.size(win))
    return df.select(*k, period_col, F.concat(pad, win).alias("window"))


def flatten_window(window: Column, cols: Sequence[str]) -> Column:
    """array<struct> -> array<double> in (row, column) order."""
    return F.flatten(F.transform(window, lambda s: F.array(*[s[c] for c in cols])))


def minmax_fit(df: DataFrame, keys, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Per-series ``min``/``max`` of each column over the fitting rows."""
    k = _keys(keys)
    src = df.filter(where) if where is not None else df
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return src.groupBy(*k).agg(*aggs)


def minmax_apply(df: DataFrame, stats: DataFrame, keys, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``(x - min) / (max - min)``; 0 when the range is 0. Joined on keys
    (co-partitioned with a keyed table; AQE may broadcast a small one)."""
    k = _keys(keys)
    if k:
        j = df.join(stats, on=k, how="left")
    else:  # one series: the stats are one global row, a proven broadcast bound
        j = df.withColumn("_all", F.lit(0)).join(F.broadcast(stats.withColumn("_all", F.lit(0))), "_all", "left").drop("_all")
    out = j.withColumns({f"{c}{suffix}": F.when(F.col(f"{c}__max") > F.col(f"{c}__min"),
                                                (F.col(c) - F.col(f"{c}__min")) / (F.col(f"{c}__max") - F.col(f"{c}__min")))
                                          .otherwise(F.lit(0.0)) for c in cols})
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("min", "max")])


def time_split(df: DataFrame, keys, fraction: float = 0.15, period_col: str = PERIOD,
               name: str = "is_validation") -> DataFrame:
    """Chronological split per series: the last ``max(1, floor(n * fraction))``
    rows are validation."""
    k = _keys(keys)
    w = series_window(k, period_col)
    whole = Window.partitionBy(*k) if k else Window.partitionBy()
    n = F.count(F.lit(1)).over(whole)
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(float(fraction))))
    return df.withColumn(name, F.row_number().over(w) > n - n_val)


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Place of the least error before ``patience`` rounds in a row brought no gain, and whether they did."""
    best = 0
    for at, e in enumerate(errors):
        if e < errors[best] or errors[best] != errors[best]:
            best = at
        elif at - best >= patience:
            return best, True
    return best, False


def boost(train: DataFrame, max_iter: int = 200, patience: int = 10, step: int = 25, seed: int = 42, depth: int = 3, rate: float = 0.1):
    """Boosted trees on ``features, label`` where not ``is_validation``, as many rounds as serve the validation rows.

    Rounds are trained in growing steps; each step's model gives the validation error after every
    round. Rounds are deterministic, so the fit cut at the best round is that round's model."""
    fit_on, held = train.filter(~F.col("is_validation")), train.filter("is_validation")

    def fitted(rounds: int):
        return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed).fit(fit_on.select("features", "label"))

    rounds = min(step, max_iter)
    while True:
        model = fitted(rounds)
        best, stopped = best_round(model.evaluateEachIteration(held.select("features", "label"), "squared"), patience)
        if stopped or rounds >= max_iter:
            return model if best + 1 == rounds else fitted(best + 1)
        rounds = min(2 * rounds, max_iter)


def sequence_backtest(df: DataFrame, keys, target: str, feature_cols: Sequence[str], n_folds: int = 5,
                      horizon: int = 6, lookback: int = 12, val_fraction: float = 0.15, max_iter: int = 200,
                      patience: int = 10, seed: int = 42, model_name: str = "sequence", min_train: int = 10,
                      period_col: str = PERIOD, parallelism: int = 4) -> DataFrame:
    """Rolling-origin backtest of the window regressor (pooled over series).

    Per fold: features min-max scaled per series on the training rows;
    windows of ``lookback`` rows ending at t-1 (for training *and* scoring);
    the last ``val_fraction`` of each series' training windows tell when to stop
    (``boost``). Series with fewer than ``min_train`` training rows are not in the fold; those with
    fewer than ``lookback + 2`` are not fitted and predict 0.0. Folds are fitted side by side.
    """
    from panelcast.operators.trees import positioned
    k = _keys(keys)
    K = int(n_folds)
    cols = [target, *feature_cols]
    rows = positioned(df, k, target, feature_cols, K, horizon, period_col).filter(F.col("ok"))
    ensure_checkpoint_dir(df.sparkSession)
    rows = rows.select(*dict.fromkeys([*k, period_col, "seg", *cols])).checkpoint()  # read by every fold
    whole = Window.partitionBy(*k) if k else Window.partitionBy()

    def fold(f: int) -> DataFrame:
        mine = (rows.filter(F.col("seg") <= f).withColumn("_rows", F.count_if(F.col("seg") < f).over(whole))
                .filter(F.col("_rows") >= min_train))
        stats = minmax_fit(mine, k, cols, F.col("seg") < f)
        sc = minmax_apply(mine, stats, k, cols)
        scols = [f"{c}_scaled" for c in cols]
        win = sc.select(*k, period_col, "seg", "_rows", flatten_window(lag_window(scols, k, lookback), scols).alias("x"),
                        F.col(f"{target}_scaled").alias("label"))
        win = win.filter((F.size("x") == lookback * len(scols)) & F.forall("x", lambda v: v.isNotNull()))
        win = win.withColumn("features", array_to_vector("x"))
        train = time_split(win.filter(F.col("seg") < f), k, val_fraction)
        train = train.withColumn("_n", F.count(F.lit(1)).over(whole)).filter(F.col("_n") >= 2)
        model = boost(train.select("features", "label", "is_validation"), max_iter, patience, seed=seed)
        p = model.transform(win.filter(F.col("seg") == f)).join(stats, on=k, how="left")
        yhat = F.when(F.col("_rows") >= lookback + 2,
                      F.col("prediction") * (F.col(f"{target}__max") - F.col(f"{target}__min")) + F.col(f"{target}__min"))
        truth = mine.filter(F.col("seg") == f).select(*k, period_col, F.col(target).alias("y_true"))
        out = truth.join(p.select(*k, period_col, yhat.alias("_yhat")), on=k + [period_col], how="left")
        return out.select(*k, F.lit(model_name).alias("model"), F.lit(f).alias("fold_idx"), period_col,
                          "y_true", F.coalesce(F.col("_yhat"), F.lit(0.0)).alias("y_pred"))

    preds = side_by_side(df.sparkSession, [lambda f=f: fold(f) for f in range(K)], parallelism)
    res = preds[0]
    for p in preds[1:]:
        res = res.unionByName(p)
    return res


def _scaled(df: DataFrame, keys, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    clean = df.na.drop(subset=list(cols))
    stats = minmax_fit(clean, keys, cols)
    return minmax_apply(clean, stats, keys, cols), stats


def sequence_fit(df: DataFrame, keys, target: str, feature_cols: Sequence[str], lookback: int = 12, val_fraction: float = 0.15,
                 max_iter: int = 200, patience: int = 10, seed: int = 42, period_col: str = PERIOD):
    """Final fit on all complete rows; the fitted Spark ML model."""
    k = _keys(keys)
    cols = [target, *feature_cols]
    scols = [f"{c}_scaled" for c in cols]
    win = _scaled(df, k, cols)[0].select(*k, period_col, flatten_window(lag_window(scols, k, lookback), scols).alias("x"),
                                         F.col(f"{target}_scaled").alias("label")).filter(F.size("x") == lookback * len(scols))
    train = time_split(win, k, val_fraction, period_col).withColumn("features", array_to_vector("x"))
    return boost(train.select("features", "label", "is_validation"), max_iter, patience, seed=seed)


def sequence_forecast(df: DataFrame, keys, target: str, feature_cols: Sequence[str], model, h: int = 12, freq: str = "month",
                      lookback: int = 12, period_col: str = PERIOD, checkpoint_every: int = 4) -> DataFrame:
    """Recursive forecast of a fitted model: the window moves on by the
    prediction, the other features are held at their last values.

    Series with fewer than ``lookback + 2`` rows get no forecast."""
    from panelcast.functions.columns import add_periods

    k = _keys(keys)
    cols = [target, *feature_cols]
    scols = [f"{c}_scaled" for c in cols]
    sc, stats = _scaled(df, k, cols)
    w = series_window(k, period_col)
    last = (sc.withColumn("x", flatten_window(lag_window(scols, k, lookback, True, period_col), scols))
            .withColumn("_n", F.row_number().over(w)).groupBy(*k)
            .agg(F.max(period_col).alias("last_period"), F.max_by("x", period_col).alias("x"), F.max("_n").alias("_n"))
            .filter(F.col("_n") >= lookback + 2).withColumn("_out", F.array().cast("array<double>")))
    width = len(scols)
    for step in range(1, h + 1):
        last = model.transform(last.withColumn("features", array_to_vector("x")))
        held = F.slice("x", width * (lookback - 1) + 2, width - 1) if width > 1 else F.array().cast("array<double>")
        last = last.select(*k, "last_period", F.concat(F.slice("x", width + 1, width * (lookback - 1)), F.array("prediction"), held).alias("x"),
                           F.concat("_out", F.array("prediction")).alias("_out"))
        if step % checkpoint_every == 0 and step < h:
            last = last.checkpoint(eager=True)
    out = last.select(*k, "last_period", F.posexplode("_out").alias("_i", "_s")).join(
        stats.select(*k, F.col(f"{target}__min").alias("_lo"), F.col(f"{target}__max").alias("_hi")), on=k)
    return out.select(*k, (F.col("_i") + 1).alias("step"), add_periods(F.col("last_period"), F.col("_i") + 1, freq).alias(PERIOD),
                      (F.col("_s") * (F.col("_hi") - F.col("_lo")) + F.col("_lo")).alias("yhat"))
