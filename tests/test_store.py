"""Runs and models kept in files, the quality gate, models that fail."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from panelcast.operators.quality import DataQualityError
from panelcast.plans.forecasters import FORECASTERS
from panelcast.plans.pipeline import RunConfig, evaluate, report, run
from panelcast.plans.store import RunStore
from panelcast.sources.io import ModelRegistry, ModelStore


def cfg(**kw):
    return RunConfig(**{**dict(keys=["k"], level_col="v", target="g", exog=["x1"], max_lag=2, windows=[3], n_folds=2, horizon=3,
                               regressors=["x1", "g_lag_1"], models=["OLS", "ARIMA", "naive"]), **kw})


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in ("a", "b", "c"):
        level, x = 100 * np.exp(np.cumsum(rng.normal(0.002, 0.02, 72))), np.cumsum(rng.normal(size=72))
        rows += [(k, dt.date(2000 + i // 12, i % 12 + 1, 1), float(level[i]), float(x[i])) for i in range(72)]
    return spark.createDataFrame(rows, "k string, period date, v double, x1 double")


@pytest.fixture(scope="module")
def stored(spark, panel):
    root = tempfile.mkdtemp(prefix="panelcast-runs-")
    held = panel.withColumn("mine", F.lit(1)).persist()
    held.count()
    return root, run(spark, panel, cfg(), store=root), held


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.slow
def test_a_report_is_made_again_from_what_a_run_stored(spark, stored):
    root, out, _ = stored
    run_id = out["manifest"].first().run_id
    other = spark.newSession()
    assert rows(report(other, run_id, root)) == rows(out["markdown"])
    assert [r.run_id for r in RunStore(other, root).runs().collect()] == [run_id]
    assert {"clean", "features", "predictions", "best", "forecast", "evidence"} <= set(RunStore(other, root).open(run_id).manifest["tables"])


@pytest.mark.slow
def test_runs_that_are_unknown_or_unfinished_are_not_opened(spark, stored, panel):
    root = stored[0]
    with pytest.raises(KeyError):
        RunStore(spark, root).open("nosuchid")
    RunStore(spark, root).begin("halfdone").write("clean", panel)
    with pytest.raises(KeyError):
        RunStore(spark, root).open("halfdone")


@pytest.mark.slow
def test_kept_models_forecast_the_same_rows_in_another_session(spark, stored):
    root, out, _ = stored
    other = spark.newSession()
    kept = RunStore(other, root).open(out["manifest"].first().run_id)
    names = kept.models.names()
    assert names and set(names) <= {"OLS", "ARIMA", "naive"}
    for name in names:
        mine = kept.table("best").filter(F.col("model") == name).select("k")
        again = FORECASTERS[name].forecast(kept.table("features").join(mine, "k", "left_semi"), cfg(), kept.models.load(name))
        label = "last_value" if name == "naive" else name
        want = out["forecast"].filter(F.col("source") == label).select("k", "step", "period", F.round("yhat", 9))
        assert rows(again.select("k", "step", "period", F.round("yhat", 9))) == rows(want)
    with pytest.raises(KeyError, match="nosuchmodel"):
        kept.models.load("nosuchmodel")


@pytest.mark.slow
def test_a_run_leaves_the_callers_caches_alone(spark, stored):
    assert stored[2].is_cached and spark._jsparkSession.sharedState().cacheManager().lookupCachedData(stored[2]._jdf).isDefined()


@pytest.mark.slow
def test_the_gate_stops_a_run(spark, panel):
    with pytest.raises(DataQualityError, match="Missing required columns.*x1"):
        run(spark, panel.drop("x1"), cfg())
    with pytest.raises(DataQualityError, match="Index(.|\n)*Missing required columns"):
        run(spark, panel.withColumn("period", F.lit(1)).drop("x1"), cfg())
    with pytest.raises(DataQualityError, match="v_non_positive"):
        run(spark, panel.withColumn("v", -F.col("v")), cfg())
    with pytest.raises(DataQualityError, match="insufficient_data"):
        run(spark, panel.filter("period < '2001-01-01'"), cfg())


class Broken:
    pooled = False

    def __init__(self, name, exc, at="backtest"):
        self.name, self.exc, self.at = name, exc, at

    def backtest(self, feats, c):
        if self.at == "backtest":
            raise self.exc
        return FORECASTERS["naive"].backtest(feats, c).withColumn("model", F.lit(self.name)).withColumn("y_pred", F.col("y_true"))

    def fit(self, feats, c):
        raise self.exc


@pytest.mark.slow
def test_models_that_fail_are_listed_with_the_reason(spark, panel):
    models = {"early": Broken("early", ValueError("no rows")), "late": Broken("late", ArithmeticError("singular"), "fit")}
    out = run(spark, panel, cfg(models=["early", "late", "naive"]), models=models)
    assert rows(out["left_out"]) == [("early", "backtest", "ValueError: no rows"), ("late", "forecast", "ArithmeticError: singular")]
    assert {r.source for r in out["forecast"].collect()} == {"last_value"} and out["forecast"].count() == 36
    with pytest.raises(RuntimeError, match="every model failed"):
        evaluate(spark, panel, cfg(models=["early"]), models=models)


@pytest.mark.slow
def test_the_clusters_failures_are_not_a_models(spark, panel):
    lost = Broken("lost", SparkRuntimeException("executor lost"))
    with pytest.raises(SparkRuntimeException):
        evaluate(spark, panel, cfg(models=["lost", "naive"]), models={"lost": lost})


def test_model_registry_round_trip(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    points = spark.createDataFrame([(float(i), float(i % 3)) for i in range(30)], "x double, label double")
    ready = VectorAssembler(inputCols=["x"], outputCol="features").transform(points)
    tree = DecisionTreeRegressor(maxDepth=3).fit(ready)
    registry, root = ModelRegistry(), tempfile.mkdtemp(prefix="panelcast-models-")
    registry.register("tree", tree)
    registry.register("table", points)
    registry.save(root, spark)
    again = ModelRegistry.load(root, spark.newSession())
    assert again.list_models() == ["table", "tree"]
    assert rows(again.get("table")) == rows(points)
    assert rows(again.get("tree").transform(ready).select("x", "prediction")) == rows(tree.transform(ready).select("x", "prediction"))
    with pytest.raises(TypeError):
        ModelStore(spark, root).save("bad", object())
