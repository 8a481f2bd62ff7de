"""OLS / HAC against an independent numpy implementation."""

import datetime as dt

import numpy as np
import pytest

from panelcast.functions.dual import SparkRel
from panelcast.operators import ols


def numpy_ols(y, X, L):
    Xc = np.column_stack([np.ones(len(y)), X])
    B = Xc.T @ Xc
    beta = np.linalg.solve(B, Xc.T @ y)
    u = y - Xc @ beta
    g = Xc * u[:, None]
    S = g.T @ g
    for l in range(1, L + 1):
        w = 1 - l / (L + 1)
        G = g[l:].T @ g[:-l]
        S += w * (G + G.T)
    Bi = np.linalg.inv(B)
    V = Bi @ S @ Bi if L > 0 else (u @ u / (len(y) - Xc.shape[1])) * Bi
    n, k = len(y), Xc.shape[1]
    ssr = u @ u
    r2 = 1 - ssr / ((y - y.mean()) @ (y - y.mean()))
    llf = -n / 2 * (np.log(2 * np.pi) + np.log(ssr / n) + 1)
    dw = np.sum(np.diff(u) ** 2) / ssr
    return beta, np.sqrt(np.diag(V)), r2, -2 * llf + 2 * k, dw


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows, truth = [], {}
    for key, n in (("a", 80), ("b", 60)):
        x1 = rng.normal(10, 3, n)
        x2 = np.cumsum(rng.normal(size=n)) * 1000 + 5e6   # large, trending: conditioning test
        e = np.zeros(n)
        for t in range(1, n):
            e[t] = 0.6 * e[t - 1] + rng.normal()
        y = 2.0 - 0.5 * x1 + 3e-4 * x2 + e
        truth[key] = (y, np.column_stack([x1, x2]))
        for t in range(n):
            rows.append((key, dt.date(2000 + t // 12, t % 12 + 1, 1), float(y[t]), float(x1[t]), float(x2[t])))
    return spark.createDataFrame(rows, "key string, period date, y double, x1 double, x2 double"), truth


@pytest.mark.parametrize("L", [0, 6])
def test_fit_matches_numpy(data, L):
    df, truth = data
    fit = ols.fit(SparkRel(df), ["key"], "y", ["x1", "x2"], hac_lags=L)
    coef = {(r.key, r.term): r for r in ols.coefficient_table(fit, ["key"], ["x1", "x2"], dp=10).df.collect()}
    stats = {r.key: r for r in ols.fit_stats_table(fit, ["key"], dp=10).df.collect()}
    for key, (y, X) in truth.items():
        beta, se, r2, aic, dw = numpy_ols(y, X, L)
        for i, term in enumerate(["const", "x1", "x2"]):
            assert coef[(key, term)].coef == pytest.approx(beta[i], rel=1e-6, abs=1e-8)
            assert coef[(key, term)].std_err == pytest.approx(se[i], rel=1e-5)
        assert stats[key].r2 == pytest.approx(r2, rel=1e-8)
        assert stats[key].aic == pytest.approx(aic, rel=1e-6)
        assert 0 <= stats[key].durbin_watson <= 4
        assert stats[key].durbin_watson == pytest.approx(dw, rel=1e-6)


def test_p_values_normal(data):
    df, _ = data
    fit = ols.fit(SparkRel(df), ["key"], "y", ["x1", "x2"], hac_lags=6)
    from math import erf, sqrt
    for r in ols.coefficient_table(fit, ["key"], ["x1", "x2"], dp=10).df.collect():
        p = 2 * (1 - 0.5 * (1 + erf(abs(r.z_stat) / sqrt(2))))
        assert r.p_value == pytest.approx(p, abs=2e-7)


def test_backtest_matches_per_fold_refit(data):
    df, truth = data
    K, h = 3, 4
    pred = ols.backtest_predictions(SparkRel(df), ["key"], "y", ["x1", "x2"], K, h).df.toPandas()
    for key, (y, X) in truth.items():
        n = len(y)
        for f in range(K):
            ts = n - (K - f) * h
            Xc = np.column_stack([np.ones(ts), X[:ts]])
            b = np.linalg.lstsq(Xc, y[:ts], rcond=None)[0]
            exp = np.column_stack([np.ones(h), X[ts:ts + h]]) @ b
            got = pred[(pred.key == key) & (pred.fold_idx == f)].sort_values("period").y_pred.to_numpy()
            np.testing.assert_allclose(got, exp, rtol=1e-7)
