"""Search and stopping rules of the tree models."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import sequence as S
from panelcast.operators import trees as T
from panelcast.operators.boosting import boosted
from panelcast.operators.parallel import side_by_side


@pytest.mark.parametrize("errors,patience,want", [
    ([5, 4, 3, 2, 1], 2, (4, False)),
    ([5, 3, 4, 4, 4, 1], 3, (1, True)),  # the late gain comes after the patience is used up
    ([5, 3, 4, 4, 1], 3, (4, False)),
    ([2, 2, 2, 2], 3, (0, True)),
    ([float("nan"), 3, 2], 5, (2, False)),
])
def test_best_round_before_a_late_bump(errors, patience, want):
    assert S.best_round(errors, patience) == want


def test_boosting_keeps_the_best_round(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 4))
    y = np.sin(2 * x[:, 0]) + rng.normal(0, 1.0, 240)  # mostly noise: more rounds fit the noise
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame([(list(map(float, r)), float(v), k >= 160) for k, (r, v) in enumerate(zip(x, y))],
                               "x array<double>, label double, is_validation boolean").withColumn("features", array_to_vector("x"))
    model = S.boost(df, max_iter=60, patience=5, step=20)
    held = df.filter("is_validation")
    whole = S.GBTRegressor(maxIter=60, maxDepth=3, stepSize=0.1, seed=42).fit(df.filter("not is_validation"))
    errors = whole.evaluateEachIteration(held, "squared")
    best, stopped = S.best_round(errors, 5)
    assert stopped and model.getNumTrees == best + 1 < 60
    assert model.evaluateEachIteration(held, "squared") == pytest.approx(errors[:best + 1])
    assert min(errors[:best + 5]) == errors[best]


def labelled(spark):
    rows = [(k, dt.date(2000 + i // 12, i % 12 + 1, 1), float(i + (100 if k == "b" else 0)), float(i % 5)) for k in "ab" for i in range(40)]
    return spark.createDataFrame(rows, "k string, period date, label double, x double")


def test_a_splits_series_level_comes_from_its_own_training_rows(spark, monkeypatch):
    """Labels rise with time: a level taken from later rows would be higher."""
    seen = []
    inner = T._ready

    def spy(rows, train, keys, cols, *kept):
        out = inner(rows, train, keys, cols, *kept)
        levels = {r.n: r.level for r in T.with_series_level(rows, train, keys, "label").groupBy("k").agg(
            F.count("*").alias("n"), F.max(T.SERIES_LEVEL).alias("level")).filter("k = 'a'").collect()}
        seen.append(levels)
        return out

    monkeypatch.setattr(T, "_ready", spy)
    T._search(labelled(spark), ["k"], ["x"], "gbt", T.sample_trials("gbt", 2, space={"n_estimators": [2], "max_depth": [2]}), 3, 1, 2)
    # 40 rows, 3 splits of 10: they train on 10, 20, 30 rows and score the next 10
    assert seen == [{20: 4.5}, {30: 9.5}, {40: 14.5}]


def test_searched_fits_do_not_depend_on_how_many_run_at_once(spark):
    rows = labelled(spark).withColumn("y", F.col("label"))
    space = {"n_estimators": [3, 5], "max_depth": [2]}
    found = [T.search(rows, ["k"], "y", ["x"], n_trials=3, cv_splits=2, space=space, parallelism=p) for p in (1, 3)]
    assert found[0] == found[1]


def test_side_by_side_keeps_order_and_passes_failures_on(spark):
    assert side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(6)], 3) == list(range(6))
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 // 0], 2)


def test_few_rows_are_fitted_in_few_partitions(spark):
    """a level of a tree starts two tasks per partition, so a split of 80 rows must not have one per shuffle partition."""
    splits = T._splits(labelled(spark), ["k"], ["x"], 2)
    assert [x.rdd.getNumPartitions() for x in splits] == [1, 1]
    assert [x.count() for x in splits] == [2 * 27, 2 * 40]


def test_folds_side_by_side_give_the_predictions_of_one_after_another(spark):
    rows = labelled(spark).withColumn("y", F.col("label"))
    space = {"n_estimators": [3, 5], "max_depth": [2]}
    found = [T.fit_predict_folds(rows, ["k"], "y", ["x"], 2, 6, n_trials=2, cv_splits=2, space=space, parallelism=p) for p in (1, 3)]
    a, b = [sorted(map(tuple, p.collect())) for p, _ in found]
    assert a == b and len(a) == 2 * 2 * 6 and found[0][1] == found[1][1]


def test_the_feature_table_of_the_refit_is_made_once(spark, monkeypatch):
    """search, refit and forecast state each scanned all of lineitem again, the refit several times."""
    from panelcast.plans import q_models as Q

    monkeypatch.setattr(Q.T, "search", lambda *a, **k: {})
    monkeypatch.setattr(Q.T, "fit_full", lambda df, *a, **k: df)
    feats, _, refit_on = Q._winner(spark, "/root/testdata/sf0.001")
    for df in (feats, refit_on):
        assert not df.inputFiles() and "FileScan" not in df._jdf.queryExecution().toString()
    assert feats.count() > 0


def noisy(n, seed=1):
    """Features with many, few, one and mostly zero values, and a label."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8))
    x[:, 2], x[:, 3] = np.round(x[:, 2]), 0.0
    x[rng.random(n) < 0.6, 4] = 0.0
    return x, 3 * x[:, 0] + np.sin(2 * x[:, 1]) + x[:, 2] + rng.normal(size=n)


@pytest.mark.parametrize("n,params", [
    (300, dict(n_estimators=12, max_depth=4, learning_rate=0.1, subsample=0.8, min_samples_leaf=2)),
    (300, dict(n_estimators=5, max_depth=5, learning_rate=0.2, subsample=1.0, min_samples_leaf=8)),
    (20, dict(n_estimators=6, max_depth=3, learning_rate=0.05, subsample=0.7, min_samples_leaf=1)),
])
def test_a_fit_within_a_task_has_spark_mls_trees(spark, n, params):
    """searched fits run within tasks; they must be the estimator's, draws included."""
    from pyspark.ml.functions import array_to_vector

    x, y = noisy(n)
    other, _ = noisy(80, 2)
    rows = [spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(a, b)], "x array<double>, label double").coalesce(1).withColumn(
        "features", array_to_vector("x")) for a, b in ((x, y), (other, np.zeros(80)))]
    model = T.make_estimator("gbt", params, 42).fit(rows[0])
    want = [r.prediction for r in model.transform(rows[1]).select("prediction").collect()]
    assert boosted(x, y, other, params, 42) == pytest.approx(want, abs=1e-9)


def test_a_searched_fit_draws_as_spark_ml_does_on_the_same_partitions(spark):
    """F1: scores of a search must not change where it runs, with rows in several partitions too."""
    x, y = noisy(200, 5)
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([(r.tolist(), float(v), i % 4 == 0) for i, (r, v) in enumerate(zip(x, y))],
                                 "x array<double>, label double, _test boolean").repartition(3).select(
        array_to_vector("x").alias("features"), "label", "_test").checkpoint()
    trials = T.sample_trials("gbt", 2, space={"n_estimators": [8], "max_depth": [3], "subsample": [0.7]})
    some, others = [T._scores(spark, [[rows]], "gbt", trials, 42, few, 2)[0] for few in (True, False)]
    assert rows.rdd.getNumPartitions() == 3 and some == pytest.approx(others, abs=1e-9)


def test_tasks_and_spark_ml_find_and_predict_the_same(spark, monkeypatch):
    """rows of a search that are too many for a task go through Spark ML."""
    x, y = noisy(120, 3)
    rows = spark.createDataFrame([("ab"[i % 2], dt.date(2000 + i // 24, i // 2 % 12 + 1, 1), float(y[i]), *map(float, x[i])) for i in range(120)],
                                 "k string, period date, y double, " + ", ".join(f"x{j} double" for j in range(8)))
    space = {"n_estimators": [3, 5], "max_depth": [2, 3], "subsample": [1.0]}  # whole samples: draws follow partitions
    found = []
    for most in (T.MOST_ROWS, 10):
        monkeypatch.setattr(T, "MOST_ROWS", most)
        preds, params = T.fit_predict_folds(rows, ["k"], "y", [f"x{j}" for j in range(8)], 2, 6, n_trials=3, cv_splits=2, space=space)
        found.append((params, sorted(map(tuple, preds.collect()))))
        assert T.search(rows, ["k"], "y", ["x0", "x1"], n_trials=3, cv_splits=2, space=space) in T.sample_trials("gbt", 3, space=space)
    (a, some), (b, others) = found
    assert a == b and [r[:5] for r in some] == [r[:5] for r in others] and len(some) == 2 * 2 * 6
    assert [r[5] for r in some] == pytest.approx([r[5] for r in others], abs=1e-9)


def test_a_fold_without_training_rows_is_an_error(spark):
    with pytest.raises(ValueError, match="no training rows"):
        T.fit_predict_folds(labelled(spark).withColumn("y", F.col("label")), ["k"], "y", ["x"], 2, 6, n_trials=1, min_train=100)


REFERENCE = dict(trials=20, splits=3, trees={100, 200, 300, 500})


def searched(monkeypatch):
    """What the searches are asked for; the first trial wins."""
    asked = []

    def spy(spark, searches, variant, trials, *rest):
        asked.append(dict(trials=len(trials), splits=len(searches[0]), trees={p["n_estimators"] for p in trials}))
        return [[float(i) for i in range(len(trials) * len(splits))] for splits in searches]

    monkeypatch.setattr(T, "_scores", spy)
    return asked


def test_the_backtest_searches_as_the_reference_does(spark, monkeypatch):
    """two trials of 10 or 20 trees over two splits stood for 20 of 100 to 500 trees over three."""
    from panelcast.plans import q_models as Q

    asked = searched(monkeypatch)
    sizes = Q.q_gbt_backtest(spark, "/root/testdata/sf0.001").select("search_trials", "search_splits", "search_most_trees").distinct().collect()
    assert asked == [REFERENCE] and [tuple(r) for r in sizes] == [(20, 3, 500)]


def test_the_forecasts_winner_is_searched_as_the_reference_does(spark, monkeypatch):
    """the same small search chose the forecast's model."""
    from panelcast.plans import q_models as Q

    asked = searched(monkeypatch)
    monkeypatch.setattr(T, "fit_full", lambda df, keys, target, cols, params, *a: params)
    _, _, params = Q._winner(spark, "/root/testdata/sf0.001")
    assert asked == [REFERENCE] and params == T.sample_trials("gbt", 20)[0]
