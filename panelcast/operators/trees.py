"""Tree-ensemble forecasters on Spark ML.

A *global* model is trained per fold over all series at once (pooled rows
of the feature table), so a fit is one distributed Spark ML job whatever
the number of series; the reference's case is a single series. Folds are
the same rolling-origin positions as for the linear models.

* ``gbt`` -> ``GBTRegressor``; ``rf`` -> ``RandomForestRegressor``.
* Hyper-parameters: trials drawn with a seeded generator from the
  reference's search space (or the caller's), scored by mean squared error on expanding
  time-series splits *inside* the training window (per-series positions;
  ``CrossValidator.foldCol`` is not used because it would train on later
  data), then the best is refit on the whole window. Folds, trials and splits run side by side:
  boosted fits of few rows as one task each (``operators/boosting.py``: the same trees), others as Spark ML's jobs.
* Scoring: missing features are forward-filled within the series, then 0.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.boosting import MOST_ROWS, boosted
from panelcast.operators.calendar import PERIOD, _keys, series_window
from panelcast.operators.parallel import side_by_side
from panelcast.session import ensure_checkpoint_dir

# The reference's search spaces.
GBT_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [2, 3, 4, 5],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "min_samples_leaf": [1, 2, 4, 8],
}
RF_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [3, 5, 7, None],
    "min_samples_leaf": [1, 2, 4, 8],
    "max_features": [0.5, 0.7, "sqrt"],
}
SPARK_MAX_DEPTH = 30  # fixed value: Spark's tree depth limit stands in for "unlimited"


def sample_trials(variant: str, n_trials: int, seed: int = 42, space: Mapping | None = None) -> list[dict]:
    """``n_trials`` distinct parameter sets drawn from the search space (the
    reference's, unless the caller gives one)."""
    space = {**(GBT_SPACE if variant == "gbt" else RF_SPACE), **(space or {})}
    names = sorted(space)
    grid = [[]]
    for n in names:
        grid = [g + [v] for g in grid for v in space[n]]
    rng = random.Random(seed)
    picks = rng.sample(range(len(grid)), min(n_trials, len(grid)))
    return [dict(zip(names, grid[i])) for i in picks]


def make_estimator(variant: str, params: Mapping, seed: int = 42,
                   features: str = "features", label: str = "label"):
    """Spark ML estimator for one parameter set (names mapped to Spark's)."""
    trees = int(params["n_estimators"])
    depth = params.get("max_depth")
    depth = SPARK_MAX_DEPTH if depth is None else int(depth)
    leaf = int(params.get("min_samples_leaf", 1))
    if variant == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth,
                            stepSize=float(params["learning_rate"]), subsamplingRate=float(params["subsample"]),
                            minInstancesPerNode=leaf, seed=seed)
    mf = params.get("max_features", "auto")
    strategy = str(mf) if isinstance(mf, str) else repr(float(mf))
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth,
                                 minInstancesPerNode=leaf, featureSubsetStrategy=strategy, seed=seed)


def scoring_fill(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    """Forward fill within the series, then 0 (the reference's predict-time fill)."""
    w = series_window(keys, period_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(w), F.lit(0.0)) for c in cols})


def _complete(cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return cond


def positioned(df: DataFrame, keys, target: str, feature_cols: Sequence[str], n_folds: int, horizon: int,
               period_col: str = PERIOD) -> DataFrame:
    """Rows with ``pos``, ``n_rows``, fold segment ``seg`` and ``ok`` (complete)."""
    k = _keys(keys)
    K, h = int(n_folds), int(horizon)
    w = series_window(k, period_col)
    whole = Window.partitionBy(*k) if k else Window.partitionBy()
    out = df.withColumns({"pos": (F.row_number().over(w) - 1).cast("bigint"),
                          "n_rows": F.count(F.lit(1)).over(whole).cast("bigint")})
    seg = F.when(F.col("pos") >= F.col("n_rows") - K * h,
                 F.lit(K) - F.ceil((F.col("n_rows") - F.col("pos")) / F.lit(float(h))).cast("bigint")).otherwise(-1)
    return (out.withColumns({"seg": seg, "ok": _complete([target, *feature_cols])})
               .filter(F.col("n_rows") >= (K + 1) * h))


SERIES_LEVEL = "series_level"


def with_series_level(rows: DataFrame, train: DataFrame, keys, label: str) -> DataFrame:
    """Adds the series' mean label over the training rows: how a pooled model knows the series."""
    k = _keys(keys)
    return rows.join(train.groupBy(*k).agg(F.avg(label).alias(SERIES_LEVEL)), on=k, how="left")


def _ready(rows: DataFrame, train: DataFrame, keys, feature_cols: Sequence[str], *kept: str) -> DataFrame:
    """Feature vectors of ``rows``; the series level comes from ``train`` alone."""
    va = VectorAssembler(inputCols=[*feature_cols, SERIES_LEVEL], outputCol="features", handleInvalid="keep")
    return va.transform(with_series_level(rows, train, keys, "label")).select("features", "label", *kept)


X = "_x"  # the features of a row as one vector


def _assembled(rows: DataFrame, feature_cols: Sequence[str], *kept: str) -> DataFrame:
    """``kept``, the label and the features as one vector: plans over the rows stay narrow, however many features there are."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=X, handleInvalid="keep")
    return va.transform(rows).select(*dict.fromkeys([*kept, "label", X]))


def _at_once(rows: DataFrame, parallelism: int) -> int:
    """Fits side by side: ``parallelism``, more where the rows lie in so few partitions that fits leave cores idle."""
    return max(parallelism, rows.sparkSession.sparkContext.defaultParallelism // max(1, rows.rdd.getNumPartitions()))


def _splits(rows: DataFrame, keys, feature_cols: Sequence[str], cv_splits: int, period_col: str = PERIOD) -> list[DataFrame]:
    """Vectors of the expanding splits of the training rows, ``_test`` marking the scored ones.

    Split i of ``cv_splits`` (per series, by complete-row position ``r`` of
    ``m`` rows, test size ``m // (cv_splits + 1)``) trains on
    ``r < m - (cv_splits - i) * size`` and tests the next ``size`` rows; the series
    level is that of the split's own training rows.

    The vectors are checkpointed, not cached: a checkpoint has the partitions that adaptive execution
    finds fit for the data's size, a cached table one per shuffle partition, and each level of each
    tree starts two tasks per partition, however few rows it has."""
    k = _keys(keys)
    ensure_checkpoint_dir(rows.sparkSession)
    whole = Window.partitionBy(*k) if k else Window.partitionBy()
    t = rows.withColumns({"_r": F.row_number().over(series_window(k, period_col)) - 1, "_m": F.count(F.lit(1)).over(whole)})
    t = t.withColumn("_sz", F.floor(F.col("_m") / (cv_splits + 1)))
    splits = []
    for i in range(cv_splits):
        edge = F.col("_m") - F.lit(cv_splits - i) * F.col("_sz")
        part = t.filter(F.col("_r") < edge + F.col("_sz")).withColumn("_test", F.col("_r") >= edge)
        splits.append(_ready(part, part.filter(~F.col("_test")), k, feature_cols, "_test").checkpoint())
    return splits


def _few(rows: DataFrame, variant: str) -> bool:
    """Whether a fit of these rows is one task: boosting, and no more rows than Spark ML takes its bins from."""
    return variant == "gbt" and 0 < rows.count() <= MOST_ROWS


ROW = "_row"  # partition (upper bits) and place of a row


def _task_fit(table: pa.Table, params: Mapping, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predictions, labels and places in the table of the test rows. The training rows must be finite, as for Spark ML, and
    come in their order there."""
    order = np.argsort(table.column(ROW).to_numpy())
    x = table.column(X).combine_chunks().flatten().to_numpy().reshape(len(table), -1)
    y, test, row = [table.column(c).to_numpy() for c in ("label", "_test", ROW)]
    train, test = order[~test[order]], order[test[order]]
    if not (np.isfinite(x[train]).all() and np.isfinite(y[train]).all()):
        raise ValueError("training features and labels must be finite")
    return boosted(x[train], y[train], x[test], params, seed, row[train] >> 33), y[test], test


def _as_arrays(vectors: DataFrame, *kept) -> DataFrame:
    return vectors.select(*kept, "label", "_test", vector_to_array("features").alias(X), F.monotonically_increasing_id().alias(ROW))


def _task_scores(searches: list[list[DataFrame]], trials: list[dict], seed: int) -> list[list[float | None]]:
    """``_scores`` as one job: a task per fit."""
    rows = reduce(DataFrame.unionByName, [_as_arrays(x, F.lit(s).alias("_search"), F.lit(i).alias("_split"))
                                          for s, splits in enumerate(searches) for i, x in enumerate(splits)])
    fit = ["_search", "_trial", "_split"]

    def score(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        got, y, _ = _task_fit(table, trials[key[1].as_py()], seed)
        mse = float(np.mean((got - y) ** 2)) if len(y) else None
        return pa.table({**{c: [v.as_py()] for c, v in zip(fit, key)}, "mse": pa.array([mse], pa.float64())},
                        pa.schema([*((c, pa.int32()) for c in fit), ("mse", pa.float64())]))

    fits = sum(map(len, searches)) * len(trials)
    each = rows.withColumn("_trial", F.explode(F.sequence(F.lit(0), F.lit(len(trials) - 1)))).repartition(fits, *fit)
    found = {tuple(r[:3]): r[3] for r in each.groupBy(*fit).applyInArrow(score, "_search int, _trial int, _split int, mse double").collect()}
    return [[found[s, t, i] for t in range(len(trials)) for i in range(len(splits))] for s, splits in enumerate(searches)]


def _scores(spark, searches: list[list[DataFrame]], variant: str, trials: list[dict], seed: int, few: bool,
            parallelism: int) -> list[list[float | None]]:
    """Per search, trial by trial, the mean squared error of each split (None without scored rows). A trial and split is
    one fit: a task where the rows are ``few``, else Spark ML's jobs, ``parallelism`` fits at a time."""
    if few:
        return _task_scores(searches, trials, seed)

    def score(params: dict, split: DataFrame) -> float | None:
        model = make_estimator(variant, params, seed).fit(split.filter(~F.col("_test")))
        return model.transform(split.filter("_test")).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]

    scores = iter(side_by_side(spark, [lambda p=p, x=x: score(p, x) for splits in searches for p in trials for x in splits], parallelism))
    return [[next(scores) for _ in trials for _ in splits] for splits in searches]


def _best(trials: list[dict], scores: list[float | None]) -> dict:
    """The trial with the least mean score; ``scores`` in the order of ``_scores``."""
    best, best_mse, per_trial = trials[0], float("inf"), len(scores) // len(trials)
    for n, params in enumerate(trials):
        mses = [m for m in scores[n * per_trial:(n + 1) * per_trial] if m is not None]
        mean = sum(mses) / len(mses) if mses else float("inf")
        if mean < best_mse:  # strict: the earlier trial wins ties
            best, best_mse = params, mean
    return best


def _search(rows: DataFrame, keys, feature_cols: Sequence[str], variant: str, trials: list[dict], cv_splits: int, seed: int,
            parallelism: int, period_col: str = PERIOD) -> dict:
    """Best trial by mean MSE over expanding splits of the training rows. A split's vectors are made once and
    shared by all trials; trials x splits fits run side by side (``_scores``)."""
    splits = _splits(rows, keys, feature_cols, cv_splits, period_col)
    return _best(trials, _scores(rows.sparkSession, [splits], variant, trials, seed, _few(rows, variant), parallelism)[0])


def _task_predictions(folds: list[DataFrame], keys, params: list[dict], seed: int, period_col: str) -> DataFrame:
    """Keys, ``fold_idx``, period, ``label`` and ``prediction`` of each fold's test rows, a task per fold."""
    k = _keys(keys)
    rows = reduce(DataFrame.unionByName, [_as_arrays(x.withColumn("_test", F.col("seg") == f), *k, period_col, F.lit(f).alias("fold_idx"))
                                          for f, x in enumerate(folds)])
    kept = [*k, "fold_idx", period_col, "label"]

    def predicted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        got, _, test = _task_fit(table, params[key[0].as_py()], seed)
        return table.take(test).select(kept).append_column("prediction", pa.array(got, pa.float64()))

    schema = rows.select(*kept, F.lit(0.0).alias("prediction")).schema
    return rows.repartition(len(folds), "fold_idx").groupBy("fold_idx").applyInArrow(predicted, schema).checkpoint()  # fitted once


def fit_predict_folds(df: DataFrame, keys, target: str, feature_cols: Sequence[str], n_folds: int = 5,
                      horizon: int = 6, variant: str = "gbt", n_trials: int = 20, cv_splits: int = 3,
                      seed: int = 42, min_train: int = 10, model_name: str = "GradientBoosting",
                      space: Mapping | None = None, period_col: str = PERIOD, parallelism: int = 4):
    """Rolling-origin backtest of a tree ensemble, searched anew in every fold.

    Returns ``(predictions, params)``; predictions are ``(keys, model,
    fold_idx, period, y_true, y_pred)``, ``params`` the last fold's winner (the refit
    searches on all rows: ``search``). ``n_trials``, ``cv_splits`` and ``space`` size the search.
    """
    k = _keys(keys)
    K = int(n_folds)
    rows = positioned(df, k, target, feature_cols, K, horizon, period_col)
    rows = rows.withColumn("label", F.col(target).cast("double")).filter(F.col("ok"))
    ensure_checkpoint_dir(df.sparkSession)
    rows = _assembled(rows, feature_cols, *k, period_col, "seg").checkpoint()  # read by every fit
    spark, trials, parallelism = df.sparkSession, sample_trials(variant, n_trials, seed, space), _at_once(rows, parallelism)
    few = _few(rows, variant)

    def prepared(f: int) -> tuple[DataFrame, list[DataFrame]]:
        train = rows.filter(F.col("seg") < f)
        cnt = train.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_train).select(*k)
        train = train.join(cnt, on=k, how="left_semi")
        if few and train.isEmpty():  # Spark ML raises too
            raise ValueError(f"fold {f} has no training rows")
        splits = _splits(train, k, [X], cv_splits, period_col) if len(trials) > 1 else []
        upto = rows.filter(F.col("seg") <= f).join(cnt, on=k, how="left_semi")
        return _ready(upto, train, k, [X], *k, period_col, "seg"), splits

    # no fold needs another's fits: all folds' splits, then all searched fits, then all last fits
    both, searches = zip(*side_by_side(spark, [lambda f=f: prepared(f) for f in range(K)], parallelism))
    found = [trials[0]] * K
    if len(trials) > 1:
        found = [_best(trials, scores) for scores in _scores(spark, list(searches), variant, trials, seed, few, parallelism)]
    if few:
        out = _task_predictions(list(both), k, found, seed, period_col)
    else:
        models = side_by_side(spark, [lambda f=f: make_estimator(variant, found[f], seed).fit(both[f].filter(F.col("seg") < f))
                                      for f in range(K)], parallelism)
        out = reduce(DataFrame.unionByName, [models[f].transform(both[f].filter(F.col("seg") == f)).withColumn("fold_idx", F.lit(f))
                                             for f in range(K)])
    return out.select(*k, F.lit(model_name).alias("model"), "fold_idx", period_col, F.col("label").alias("y_true"),
                      F.col("prediction").alias("y_pred")), found[-1]


def _labelled(df: DataFrame, keys, target: str, feature_cols: Sequence[str], *kept: str) -> DataFrame:
    """The complete rows with their label."""
    rows = df.filter(_complete([target, *feature_cols])).withColumn("label", F.col(target).cast("double"))
    return rows.select(*dict.fromkeys([*_keys(keys), *kept, "label", *feature_cols]))


def search(df: DataFrame, keys, target: str, feature_cols: Sequence[str], variant: str = "gbt", n_trials: int = 20,
           cv_splits: int = 3, seed: int = 42, space: Mapping | None = None, period_col: str = PERIOD, parallelism: int = 4) -> dict:
    """The search on every complete row: the final fit's parameters."""
    trials = sample_trials(variant, n_trials, seed, space)
    if len(trials) == 1:
        return trials[0]
    ensure_checkpoint_dir(df.sparkSession)
    rows = _assembled(_labelled(df, keys, target, feature_cols, period_col), feature_cols, *_keys(keys), period_col).checkpoint()
    return _search(rows, keys, [X], variant, trials, cv_splits, seed, _at_once(rows, parallelism), period_col)


def fit_full(df: DataFrame, keys, target: str, feature_cols: Sequence[str], params: Mapping,
             variant: str = "gbt", seed: int = 42):
    """Fit on every complete row (final model). Returns the fitted model; its
    features are ``feature_cols`` and the series' level. ``df`` is read once: Spark ML passes over
    its input several times, and the level is an aggregate of the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = _labelled(df, keys, target, feature_cols).checkpoint()
    return make_estimator(variant, params, seed).fit(_ready(rows, rows, keys, feature_cols))


def forecast_state(df: DataFrame, keys, target: str, feature_cols: Sequence[str], max_lag: int) -> DataFrame:
    """Per series the filled last feature row, the level and the target's history."""
    from panelcast.operators.forecast import last_rows, last_values

    k = _keys(keys)
    last = last_rows(scoring_fill(df, k, list(feature_cols)), k, feature_cols)
    return with_series_level(last, df.filter(_complete([target, *feature_cols])), k, target).fillna(
        0.0, [SERIES_LEVEL]).join(last_values(df, k, target, max_lag), k)


def importances(spark, model, feature_cols: Sequence[str]) -> DataFrame:
    """``(feature, importance, rank)`` sorted by importance, descending."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(feature_cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.withColumn("rank", F.row_number().over(w))
