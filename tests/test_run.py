"""End-to-end runs on difficult input, and estimators against numpy only."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.dual import SparkRel
from panelcast.operators import arma, ols
from panelcast.plans.pipeline import RunConfig, row_counts, run


def months(n, first=1990):
    return [dt.date(first + i // 12, i % 12 + 1, 1) for i in range(n)]


def panel(spark, **series):
    """name -> (levels, x1, x2); None leaves the month out."""
    rows = [(k, d, None if v is None else float(v), float(a), float(b)) for k, (lv, x1, x2) in series.items()
            for d, v, a, b in zip(months(len(lv)), lv, x1, x2) if v is not None]
    return spark.createDataFrame(rows, "k string, period date, v double, x1 double, x2 double")


@pytest.fixture(scope="module")
def awkward(spark):
    rng = np.random.default_rng(0)
    n = 84
    level = 100 * np.exp(np.cumsum(rng.normal(0.002, 0.01, n)))
    walk = lambda: np.cumsum(rng.normal(size=n))
    x = walk()
    return panel(spark, plain=(level, walk(), walk()), constant=(level[::-1], np.full(n, 2.0), walk()),
                 collinear=(level + 5, x, 3 * x), steady=(100 * 1.01 ** np.arange(n), walk(), walk()),
                 short=(level[:20], walk()[:20], walk()[:20]))


def cfg(**kw):
    return RunConfig(**{**dict(keys=["k"], level_col="v", target="g", exog=["x1", "x2"], max_lag=2, windows=[3], n_folds=2, horizon=3,
                               regressors=["x1", "x2", "g_lag_1"], models=["OLS", "naive"]), **kw})


@pytest.mark.slow
def test_every_series_gets_a_whole_forecast(spark, awkward):
    out = run(spark, awkward, cfg(), strict=False)  # one series is too short for the gate
    rows = out["forecast"].collect()
    assert len(rows) == 5 * 12 and all(r.yhat is not None and math.isfinite(r.yhat) for r in rows)
    assert {r.k for r in rows} == {"plain", "constant", "collinear", "steady", "short"}
    assert not any("null" in r.markdown for r in out["markdown"].collect())


def test_change_of_a_gappy_series_uses_the_calendar(spark):
    """With three months removed, a change still compares with the month a year before (filled in)."""
    from panelcast.plans.pipeline import prepare

    level = [100.0 + k for k in range(60)]
    whole = [v if k not in (17, 30, 31) else None for k, v in enumerate(level)]
    one = panel(spark, a=(whole, range(60), range(60)))
    c = cfg(exog=[], regressors=["g_lag_1"], missing_threshold_pct=1.0)
    clean, feats = prepare(one, c)
    got = {r.period: r.g for r in feats.collect()}
    assert clean.count() == 60
    for k in range(13, 60):
        assert got[months(60)[k]] == pytest.approx((level[k] / level[k - 12] - 1) * 100, rel=1e-2)
    counts = row_counts(one, clean, feats, c).first()
    assert (counts.rows_given, counts.rows_on_calendar, counts.rows_with_features, counts.rows_dropped) == (57, 60, 47, 13)


# --- estimators against numpy, without the shared expression builder -------------------------------


def t_two_sided(t, df):
    """Student-t tail by numerical integration."""
    x = np.linspace(0, abs(t), 200_001)
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    y = c * (1 + x * x / df) ** (-(df + 1) / 2)
    return 1 - 2 * float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(47, 3))
    y = 1.0 + x @ [0.5, -0.2, 0.0] + rng.normal(size=47)
    rows = [("a", d, float(v), *map(float, r)) for d, v, r in zip(months(47), y, x)]
    return spark.createDataFrame(rows, "k string, period date, y double, a double, b double, c double"), y, x


def test_classic_errors_and_student_t(spark, regression):
    df, y, x = regression
    X = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    u = y - X @ beta
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * (u @ u) / (len(y) - 4))
    got = {r.term: r for r in ols.coefficient_table(ols.fit(SparkRel(df), ["k"], "y", ["a", "b", "c"], hac_lags=0), ["k"],
                                                    ["a", "b", "c"], dp=9, robust=False).df.collect()}
    for i, term in enumerate(["const", "a", "b", "c"]):
        assert got[term].coef == pytest.approx(beta[i], abs=1e-8) and got[term].std_err == pytest.approx(se[i], abs=1e-8)
        assert got[term].p_value == pytest.approx(t_two_sided(beta[i] / se[i], len(y) - 4), abs=1e-7)


@pytest.mark.parametrize("t,df,p", [(2.0, 10, 0.073388), (1.96, 1000, 0.050273), (0.5, 5, 0.638299), (3.0, 1, 0.204833), (-2.5, 2, 0.129612)])
def test_student_t_values(spark, t, df, p):
    got = spark.range(1).selectExpr(f"{ols.student_p(f'{t}D', f'{df}D', 'spark')} AS p").first().p
    assert got == pytest.approx(p, abs=2e-6)


def test_newey_west_errors(spark, regression):
    df, y, x = regression
    X = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    g = X * (y - X @ beta)[:, None]
    S = g.T @ g
    for lag in range(1, 5):
        G = g[lag:].T @ g[:-lag]
        S += (1 - lag / 5) * (G + G.T)
    bread = np.linalg.inv(X.T @ X)
    se = np.sqrt(np.diag(bread @ S @ bread))
    got = {r.term: r.std_err for r in ols.coefficient_table(ols.fit(SparkRel(df), ["k"], "y", ["a", "b", "c"], hac_lags=4), ["k"],
                                                            ["a", "b", "c"], dp=9).df.collect()}
    assert [got[t] for t in ("const", "a", "b", "c")] == pytest.approx(list(se), abs=1e-8)


def test_a_collinear_regressor_is_dropped_not_the_fit(spark, regression):
    df, y, x = regression
    twice = df.withColumn("c", 2 * F.col("a")).withColumn("one", F.lit(1.0))
    fit = ols.fit(SparkRel(twice), ["k"], "y", ["a", "b", "c", "one"]).df.first()
    X = np.column_stack([np.ones(len(y)), x[:, :2]])
    u = y - X @ np.linalg.lstsq(X, y, rcond=None)[0]
    assert fit["_ossr"] == pytest.approx(u @ u, rel=1e-9)


def np_adf(y, bound):
    """(lags, statistic) on the common sample of all lag counts, by numpy."""
    d = np.diff(y)
    best = None
    for p in range(bound + 1):
        rows = np.arange(bound, len(d))
        X = np.column_stack([np.ones(len(rows)), y[rows]] + [d[rows - i] for i in range(1, p + 1)])
        b = np.linalg.lstsq(X, d[rows], rcond=None)[0]
        u = d[rows] - X @ b
        n = len(rows)
        aic = n * (math.log(2 * math.pi) + math.log(u @ u / n) + 1) + 2 * (p + 2)
        stat = b[1] / math.sqrt(np.linalg.inv(X.T @ X)[1, 1] * (u @ u) / (n - p - 2))
        if best is None or aic < best[0]:
            best = (aic, p, stat, n)
    return best[1:]


def test_adf_bound_grows_with_each_series(spark):
    rng = np.random.default_rng(8)
    series = {"long": np.cumsum(rng.normal(size=90)), "mid": rng.normal(size=40), "tiny": [1.0, 2.0, 1.5], "flat": [3.0] * 30}
    df = spark.createDataFrame([(k, d, float(v)) for k, s in series.items() for d, v in zip(months(len(s)), s)], "k string, period date, y double")
    got = {r.k: r for r in arma.adf(SparkRel(df), ["k"], "y").df.collect()}
    assert set(got) == set(series) and got["tiny"].d == 1 and got["flat"].d == 1
    for k in ("long", "mid"):
        lag, stat, n = np_adf(np.array(series[k]), arma.lag_bound(len(series[k])))
        assert (got[k].adf_lag, got[k].adf_n) == (lag, n) and got[k].adf_stat == pytest.approx(stat, rel=1e-6)


def test_forecast_steps_follow_the_frequency(spark):
    rng = np.random.default_rng(2)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(80)]
    df = spark.createDataFrame([("a", d, float(v)) for d, v in zip(days, rng.normal(size=80))], "k string, period date, y double")
    rel = SparkRel(df)
    fit = arma.hannan_rissanen(rel, ["k"], "y", arma.adf(rel, ["k"], "y", 2))
    got = [r.period for r in arma.forecast_rows(fit, ["k"], 3, freq="day").df.sort("step").collect()]
    assert got == [days[-1] + dt.timedelta(days=i) for i in (1, 2, 3)]
