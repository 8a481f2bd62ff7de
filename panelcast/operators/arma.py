"""ARIMA per series, re-aimed for Spark.

* ``adf``: augmented Dickey-Fuller regression ``dy_t = a + g*y_{t-1} +
  sum_i c_i dy_{t-i}`` for every lag count 0..K on one common sample, K
  growing with the series' length (``lag_bound``); the
  lag count with the lowest AIC is kept and ``d = 0`` when the t-statistic
  of ``g`` is below the 5 % critical value, else ``d = 1``. A series too
  short or too regular for the regression gets ``d = 1``.
* ``hannan_rissanen``: ARMA(p, q) on the d-times differenced series by the
  two-regression method of Hannan & Rissanen (1982): a long AR gives
  innovation estimates, then ``w_t`` is regressed on its own lags and the
  lagged innovations. All (p, q) of the grid share one sample, so the
  cross-products are aggregated ONCE per series and each order is a masked
  solve on that one row (``ols.solve(active=...)``); minimum AIC
  wins, ties to the earlier order (p first, then q). A constant is fitted
  only when d = 0.
* ``forecast``: the ARMA recursion rolled forward with future innovations
  0, integrated when d = 1, and a 95 % band from the psi-weights.

Maximum-likelihood ARIMA (the reference's estimator) is not reproduced:
Hannan-Rissanen estimates are consistent but not identical.

Every step is expression text (see ``functions.dual``) so the same code
runs on Spark and, for the oracle, in DuckDB.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from panelcast.functions.dual import div, win
from panelcast.operators import ols
from panelcast.operators.ols import P, prepare, sum_exprs

# Fixed value: 5 % asymptotic critical value of the ADF t-statistic with a
# constant and no trend (MacKinnon 2010, tau_c).
ADF_CRIT_5PCT = -2.86154
LN_2PI = "ln(2.0 * pi())"


def _carry(col: str, dialect: str) -> str:
    return f"first({col})" if dialect == "spark" else f"any_value({col})"


def _keep(rel, cols: Sequence[str]):
    return rel.select([(c, c) for c in cols])


def grid_orders(max_p: int = 3, max_q: int = 2) -> list[tuple[int, int]]:
    return [(p, q) for p in range(max_p + 1) for q in range(max_q + 1) if (p, q) != (0, 0)]


def _case_index(idx: str, values: Sequence) -> str:
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def lag_bound(n: int) -> int:
    """Largest ADF lag count for ``n`` observations: ceil(12 (n/100)^(1/4)),
    at most n // 2 - 2 (one constant)."""
    return max(-1, min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))


def longest(rel, G: Sequence[str], y: str) -> int:
    """Observations of the longest series (one small job)."""
    found = rel.filter(f"{y} IS NOT NULL").group(list(G), [("_n", "count(*)")]).df.agg({"_n": "max"}).first()
    return int(found[0] or 0)


def adf(rel, G: Sequence[str], y: str, max_lag: int | None = None, order: str = "period"):
    """Per group: ``adf_lag, adf_stat, adf_n, d``; every group of ``rel`` has a row.

    ``max_lag`` is the number of lag columns: the bound of the longest
    series (computed when not given). Each series uses the lags up to its own bound."""
    d = rel.dialect
    if max_lag is None:
        max_lag = lag_bound(longest(rel, G, y))
    K = max(0, int(max_lag))
    w = win(G, order)
    rel = _keep(rel, list(G) + [order, y]).share()
    groups = rel.group(list(G), [("_a_rows", "count(*)")])
    rel = rel.stages([[("_a_ylag", f"lag({y}, 1) {w}"),
                       ("_a_cnt", f"count({y}) {win(G)}")],
                      [("_a_dy", f"{y} - _a_ylag"),
                       ("_a_bound", "CAST(least(ceil(12.0 * pow(_a_cnt / 100.0, 0.25)), floor(_a_cnt / 2.0) - 2) AS INT)")],
                      [(f"_a_dl{i}", f"CASE WHEN {i} <= _a_bound THEN lag(_a_dy, {i}) {w} ELSE 0.0 END") for i in range(1, K + 1)]])
    xs = ["_a_ylag"] + [f"_a_dl{i}" for i in range(1, K + 1)]
    k = len(xs)
    rel = prepare(rel, G, "_a_dy", xs).filter(f"{P}ok AND _a_bound >= 0")
    carry = [(f"{P}{nm}{j}", _carry(f"{P}{nm}{j}", d)) for j in range(k) for nm in ("mx", "sx")]
    rel = rel.group(list(G), sum_exprs(k) + carry + [("_a_bound", _carry("_a_bound", d))])
    n = f"{P}n"
    if d == "spark":
        # the lag models are nested: one pass over the packed system gives all of them
        rel = ols.packed_system(rel, k)
        rel = _keep(rel, [*G, n, "_a_bound", f"{P}A"]).swept(f"{P}A", "_a_path", k, k + 1, kept=(k, 0, (k + 1) ** 2 - 1))
        rel = rel.explode("adf_lag", f"sequence(0, least(_a_bound, {K}))")
        rel = rel.replace(["_a_path"], [(f"{P}b0", "_a_path[3 * adf_lag]"), (f"{P}Ci0_0", "-_a_path[3 * adf_lag + 1]"),
                                        (f"{P}ssr", "greatest(_a_path[3 * adf_lag + 2], 0D)")])
    else:
        rel = rel.explode("adf_lag", rel.int_range(0, K)).filter("adf_lag <= _a_bound")
        rel = ols.solve(rel, k, active=["TRUE"] + [f"adf_lag >= {i}" for i in range(1, K + 1)], inverse=True)
    rel = rel.stages([[("_a_llf", f"-{n} / 2.0 * ({LN_2PI} + {_ln(div(f'{P}ssr', n, d))} + 1.0)"),
                       ("_a_s2", f"CASE WHEN {n} > adf_lag + 2 THEN {div(f'{P}ssr', f'{n} - (adf_lag + 2)', d)} END")],
                      [("_a_aic", "-2.0 * _a_llf + 2.0 * (adf_lag + 2)"),
                       ("adf_stat", div(f"{P}b0", f"sqrt(CASE WHEN _a_s2 * {P}Ci0_0 >= 0 THEN _a_s2 * {P}Ci0_0 END)", d))]])
    # failed regressions rank last; they are not filtered out, as a filter on staged columns would be inlined into every stage
    rank = "CASE WHEN _a_aic IS NULL OR adf_stat IS NULL THEN 1 ELSE 0 END, _a_aic, adf_lag"
    rel = rel.stages([[("_a_rk", f"row_number() {win(G, rank)}")]]).filter("_a_rk = 1")
    rel = rel.select([(g, g) for g in G] + [("adf_lag", "adf_lag"), ("adf_stat", "adf_stat"), ("adf_n", n)])
    out = groups.join(rel, list(G), "left")
    return out.select([(g, g) for g in G] + [
        ("adf_lag", "CAST(adf_lag AS INT)"), ("adf_stat", "adf_stat"), ("adf_n", "CAST(adf_n AS BIGINT)"),
        ("d", f"CAST(CASE WHEN adf_stat < {ADF_CRIT_5PCT!r} THEN 0 ELSE 1 END AS INT)")])


def _ln(x: str) -> str:
    """Logarithm, NULL where there is none."""
    return f"ln(CASE WHEN ({x}) > 0 THEN ({x}) END)"


def hannan_rissanen(rel, G: Sequence[str], y: str, d_rel, max_p: int = 3, max_q: int = 2,
                    long_ar: int | None = None, order: str = "period"):
    """Best ARMA order per group on the differenced series (see module doc).

    ``d_rel`` holds ``(G, d)``. Output per group: ``p, d, q, aic, bic,
    sigma2, n_obs, c, phi1..phi{max_p}, theta1..theta{max_q}`` and the
    state needed to forecast (last w's, last innovations, last y, last period).
    """
    dl = rel.dialect
    m = int(long_ar or max(max_p, max_q) + 3)
    w = win(G, order)
    rel = _keep(rel, list(G) + [order, y]).join(d_rel.select([(g, g) for g in G] + [("d", "d")]), G)
    rel = rel.stages([[("_h_w", f"CASE WHEN d = 1 THEN {y} - lag({y}, 1) {w} ELSE {y} END")],
                      [(f"_h_wl{i}", f"lag(_h_w, {i}) {w}") for i in range(1, max(m, max_p) + 1)]])
    # step 1: long autoregression -> innovation estimates e_t
    lx = [f"_h_wl{i}" for i in range(1, m + 1)]
    r1 = prepare(rel, G, "_h_w", lx).share()
    # a long autoregression on fewer rows is nearly saturated: its innovations would be rounding noise
    sums = r1.filter(f"{P}ok").group(list(G), sum_exprs(m)).filter(f"{P}n >= {2 * (m + 1)}")
    long_fit = ols.solve(sums, m, batched=True)
    r1 = r1.join(_keep(long_fit, list(G) + ols.solution_columns(m)), G, "left")
    fit1 = " + ".join(f"{P}b{j} * ({P}t{j} - {P}tb{j})" for j in range(m))
    r1 = r1.stages([[("_h_e", f"CASE WHEN {P}ok THEN {P}ty - ({P}alpha + {fit1}) END")]])
    keep = list(G) + [order, y, "d", "_h_w", "_h_e"] + [f"_h_wl{i}" for i in range(1, max_p + 1)]
    r2 = _keep(r1, keep)
    r2 = r2.stages([[(f"_h_el{j}", f"lag(_h_e, {j}) {w}") for j in range(1, max_q + 1)]])
    xs = [f"_h_wl{i}" for i in range(1, max_p + 1)] + [f"_h_el{j}" for j in range(1, max_q + 1)]
    k = len(xs)
    r2 = prepare(r2, G, "_h_w", xs, center=False).filter(f"{P}ok")
    last = [("last_period", f"max({order})"), ("last_y", f"max_by({y}, {order})"),
            ("d", _carry("d", dl))]
    last += [(f"w_t{i}", f"max_by({'_h_w' if i == 0 else f'_h_wl{i}'}, {order})") for i in range(max_p)]
    last += [(f"e_t{j}", f"max_by({'_h_e' if j == 0 else f'_h_el{j}'}, {order})") for j in range(max_q)]
    carry = [(f"{P}{nm}{j}", _carry(f"{P}{nm}{j}", dl)) for j in range(k) for nm in ("mx", "sx")]
    carry.append((f"{P}my", _carry(f"{P}my", dl)))
    g = r2.group(list(G), sum_exprs(k) + carry + last)
    orders = grid_orders(max_p, max_q)
    g = g.explode("_h_idx", g.int_range(0, len(orders) - 1))
    g = g.stages([[("p", _case_index("_h_idx", [o[0] for o in orders])),
                   ("q", _case_index("_h_idx", [o[1] for o in orders]))]])
    active = [f"p >= {i}" for i in range(1, max_p + 1)] + [f"q >= {j}" for j in range(1, max_q + 1)]
    icpt = "d = 0"
    g = ols.solve(g, k, active=active, intercept=icpt, batched=True)
    n = f"{P}n"
    npar = "(p + q + CASE WHEN d = 0 THEN 1 ELSE 0 END + 1)"
    g = g.stages([[("sigma2", div(f"{P}ssr", n, dl))],
                  [("_h_llf", f"-{n} / 2.0 * ({LN_2PI} + {_ln('sigma2')} + 1.0)")],
                  [("aic", f"-2.0 * _h_llf + 2.0 * {npar}"), ("bic", f"-2.0 * _h_llf + {npar} * ln({n})")],
                  # failed orders (NULL) come last; without any AIC (a perfect fit) the order is (1, d, 1)
                  [("_h_rk", f"row_number() {win(G, 'aic NULLS LAST, CASE WHEN p = 1 AND q = 1 THEN 0 ELSE 1 END, _h_idx')}")]])
    g = g.filter("_h_rk = 1")
    coefs = [(f"phi{i + 1}", div(f"{P}b{i}", f"{P}sx{i}", dl)) for i in range(max_p)]
    coefs += [(f"theta{j + 1}", div(f"{P}b{max_p + j}", f"{P}sx{max_p + j}", dl)) for j in range(max_q)]
    # intercept in original units (mx = 0 without centring): alpha - sum b_j * tb_j
    cst = " + ".join(f"{P}b{j} * {P}tb{j}" for j in range(k))
    coefs.append(("c", f"CASE WHEN d = 0 THEN {P}alpha - ({cst}) ELSE 0.0 END"))
    g = g.stages([coefs])
    cols = list(G) + ["p", "d", "q", "aic", "bic", "sigma2"]
    out = [(c, c) for c in cols] + [("n_obs", f"CAST({n} AS BIGINT)")]
    out += [(c, f"coalesce({c}, 0.0)") for c in [f"phi{i + 1}" for i in range(max_p)] + [f"theta{j + 1}" for j in range(max_q)]]
    out += [("c", "c"), ("last_period", "last_period"), ("last_y", "last_y")]
    out += [(f"w_t{i}", f"w_t{i}") for i in range(max_p)] + [(f"e_t{j}", f"e_t{j}") for j in range(max_q)]
    return g.select(out)


def forecast_sql_stages(h: int, max_p: int = 3, max_q: int = 2, z: float = 1.96) -> list:
    """Unrolled ARIMA forecast + psi-weight band as h + 1 stages (the oracle's form).

    Stage s computes the differenced forecast ``_f_w{s}``, the level
    ``f{s}`` (integrated when d = 1), the psi-weight ``_f_psi{s}``, its
    running sum ``_f_cum{s}`` and the running forecast-error variance
    factor ``_f_v{s}``; the last stage forms ``lo{s}``/``hi{s}``.
    """
    def W(t):   # w at step t (t <= 0: observed; t >= 1: forecast)
        return f"_f_w{t}" if t >= 1 else f"w_t{-t}"

    def E(t):
        return "0.0" if t >= 1 else f"e_t{-t}"

    def psi(j):
        return "1.0" if j == 0 else f"_f_psi{j}"

    def cum(j):
        return "1.0" if j == 0 else f"_f_cum{j}"

    stages = []
    for s in range(1, h + 1):
        terms = ["c"] + [f"phi{i} * {W(s - i)}" for i in range(1, max_p + 1)]
        terms += [f"theta{j} * {E(s - j)}" for j in range(1, max_q + 1)]
        w_s = " + ".join(terms)
        prev = "last_y" if s == 1 else f"f{s - 1}"
        t = [f"theta{s}"] if s <= max_q else []
        t += [f"phi{i} * {psi(s - i)}" for i in range(1, min(s, max_p) + 1)]
        psi_s = " + ".join(t) if t else "0.0"
        v_prev = "0.0" if s == 1 else f"_f_v{s - 1}"
        last = f"CASE WHEN d = 1 THEN {cum(s - 1)} ELSE {psi(s - 1)} END"
        stages.append([(f"_f_w{s}", w_s),
                       (f"f{s}", f"CASE WHEN d = 1 THEN {prev} + ({w_s}) ELSE ({w_s}) END"),
                       (f"_f_psi{s}", psi_s),
                       (f"_f_cum{s}", f"{cum(s - 1)} + ({psi_s})"),
                       (f"_f_v{s}", f"{v_prev} + ({last}) * ({last})")])
    stages.append([(f"lo{s}", f"f{s} - {z!r} * sqrt(sigma2 * _f_v{s})") for s in range(1, h + 1)]
                  + [(f"hi{s}", f"f{s} + {z!r} * sqrt(sigma2 * _f_v{s})") for s in range(1, h + 1)])
    return stages


def forecast_path(h: int, max_p: int = 3, max_q: int = 2, z: float = 1.96) -> str:
    """Spark text: the same forecast as one fold over the steps, an array of
    ``step, yhat, lo, hi``; the state holds the last values, newest first."""
    def newest(new: str, old: str, most: int) -> str:
        return f"slice(concat(array({new}), {old}), 1, {max(1, most)})"

    def rows(names: Sequence[str]) -> str:
        return f"array({', '.join(names) or '0D'})"

    w = " + ".join(["c"] + [f"phi{i} * s.w[{i - 1}]" for i in range(1, max_p + 1)] + [f"theta{j} * s.e[{j - 1}]" for j in range(1, max_q + 1)])
    theta = f"CASE k {' '.join(f'WHEN {j} THEN theta{j}' for j in range(1, max_q + 1))} ELSE 0D END" if max_q else "0D"
    psi = " + ".join([theta] + [f"phi{i} * s.psi[{i - 1}]" for i in range(1, max_p + 1)])
    now = (f"named_struct('w', {w}, 'psi', {psi}, 'v', s.v + pow(CASE WHEN d = 1 THEN s.cum ELSE s.psi[0] END, 2))")
    level = "CASE WHEN d = 1 THEN s.y + x.w ELSE x.w END"
    band = f"{z!r}D * sqrt(sigma2 * x.v)"
    start = ("named_struct('w', " + rows([f"w_t{i}" for i in range(max_p)]) + ", 'e', " + rows([f"e_t{j}" for j in range(max_q)])
             + f", 'y', last_y, 'psi', {rows(['1D'] + ['0D'] * (max_p - 1))}, 'cum', 1D, 'v', 0D, "
             "'out', CAST(array() AS ARRAY<STRUCT<step: INT, yhat: DOUBLE, lo: DOUBLE, hi: DOUBLE>>))")
    step = (f"named_struct('w', {newest('x.w', 's.w', max_p)}, 'e', {newest('0D', 's.e', max_q)}, 'y', {level}, "
            f"'psi', {newest('x.psi', 's.psi', max_p)}, 'cum', s.cum + x.psi, 'v', x.v, "
            f"'out', concat(s.out, array(named_struct('step', k, 'yhat', {level}, 'lo', {level} - {band}, 'hi', {level} + {band}))))")
    return f"aggregate(sequence(1, {int(h)}), {start}, (s, k) -> transform(array({now}), x -> {step})[0], s -> s.out)"


def period_text(col: str, steps: int | str, freq: str, dialect: str) -> str:
    """``col`` moved by ``steps`` periods, as expression text."""
    if dialect == "spark":
        return {"month": f"add_months({col}, {steps})", "day": f"date_add({col}, {steps})",
                "hour": f"CAST({col} + make_dt_interval(0, {steps}) AS TIMESTAMP_NTZ)"}[freq]
    return {"month": f"CAST({col} + to_months({steps}) AS DATE)", "day": f"CAST({col} + to_days({steps}) AS DATE)",
            "hour": f"{col} + to_hours({steps})"}[freq]


def forecast_rows(rel, G: Sequence[str], h: int, max_p: int = 3, max_q: int = 2, freq: str = "month"):
    """``(G, step, period, yhat, lo, hi)`` from a ``hannan_rissanen`` result."""
    if rel.dialect == "spark":
        rel = rel.select([(g, g) for g in G] + [("last_period", "last_period"), ("_f", forecast_path(h, max_p, max_q))]).explode("_f", "_f")
        return rel.select([(g, g) for g in G] + [("step", "_f.step"), ("period", period_text("last_period", "_f.step", freq, "spark")),
                                                 ("yhat", "_f.yhat"), ("lo", "_f.lo"), ("hi", "_f.hi")])
    rel = rel.stages(forecast_sql_stages(h, max_p, max_q))
    parts = []
    for s in range(1, h + 1):
        per = period_text("last_period", s, freq, rel.dialect)
        parts.append([(g, g) for g in G] + [("step", f"CAST({s} AS INT)"), ("period", per),
                                            ("yhat", f"f{s}"), ("lo", f"lo{s}"), ("hi", f"hi{s}")])
    return ols.union_selects(rel, parts)


def backtest_predictions(rel, keys: Sequence[str], y: str, n_folds: int = 5, horizon: int = 6,
                         complete_cols: Sequence[str] = (), min_train: int = 10, model: str = "ARIMA",
                         max_p: int = 3, max_q: int = 2, adf_lags: int | None = None, order: str = "period",
                         long_ar: int | None = None):
    """Rolling-origin ARIMA: refit per (series, fold) on that fold's complete
    training rows, forecast ``horizon`` steps, pair the k-th step with the
    k-th complete test row.

    The (row, fold) pairs are generated in place by exploding fold indices
    (K copies of the *resampled* series, never of raw data); grouping by
    ``keys + fold_idx`` reuses the hash partitioning on ``keys``.
    """
    K, h = int(n_folds), int(horizon)
    G = list(keys) + ["fold_idx"]
    r = ols.positions(rel, keys, K, h, order)
    r = r.explode("fold_idx", r.int_range(0, K - 1))
    r = r.filter(f"pos < n_rows - ({K} - fold_idx - 1) * {h}")
    okc = ols.ok_expr(y, [c for c in complete_cols if c != y])
    r = r.stages([[("_b_ok", f"({okc})"),
                   ("_b_test", f"pos >= n_rows - ({K} - fold_idx) * {h}")]])
    r = _keep(r, G + [order, y, "_b_ok", "_b_test"]).share()
    train = r.filter("_b_ok AND NOT _b_test")
    train = train.stages([[("_b_ntr", f"count(*) {win(G)}")]]).filter(f"_b_ntr >= {int(min_train)}")
    train = _keep(train, G + [order, y]).share()
    d = adf(train, G, y, max_lag=adf_lags, order=order)
    fit = hannan_rissanen(train, G, y, d, max_p=max_p, max_q=max_q, long_ar=long_ar, order=order)
    fc = forecast_rows(fit, G, h, max_p, max_q)
    fc = fc.select([(g, g) for g in G] + [("step", "step"), ("y_pred", "yhat")])
    test = r.filter("_b_ok AND _b_test").stages([[("step", f"CAST(row_number() {win(G, order)} AS INT)")]])
    test = test.select([(g, g) for g in G] + [("step", "step"), (order, order), ("y_true", y)])
    j = test.join(fc, G + ["step"])
    return j.select([(k, k) for k in keys] + [("model", f"'{model}'"), ("fold_idx", "CAST(fold_idx AS INT)"),
                                               ("period", order), ("y_true", "y_true"), ("y_pred", "y_pred")])


# --- third step of Hannan & Rissanen -----------------------------------------------------------

def _recursion(max_p: int, max_q: int, phi: str, theta: str, c: str) -> str:
    """Spark text: the innovation of ``x`` after state ``s`` (``w, e``: last values, newest first)."""
    terms = [f"{phi}[{i}] * s.w[{i}]" for i in range(max_p)] + [f"{theta}[{j}] * s.e[{j}]" for j in range(max_q)]
    return f"x - {c}" + "".join(f" - {t}" for t in terms)


def _push(new: str, old: str, most: int) -> str:
    return f"slice(concat(array({new}), {old}), 1, {most})"


def refine_text(max_p: int = 3, max_q: int = 2) -> dict[str, str]:
    """Spark texts over ``_r_w`` (the differenced series in order), ``_r_phi, _r_theta, c, p, q``.

    ``normal``: the normal equations of the innovations on their derivatives by the parameters. These are
    the series and the innovations filtered by the moving-average part (eta, xi, kappa for the
    constant), so one fold over the series carries filters and sums together.
    ``css``: squared innovations summed, given ``phi, theta, c`` as names of columns."""
    m, n = max(max_p, max_q, 1), max_p + max_q + 2

    def filtered(new: str, name: str) -> str:
        return new + "".join(f" - _r_theta[{j}] * s.{name}[{j}]" for j in range(max_q))

    e = _recursion(max_p, max_q, "_r_phi", "_r_theta", "c")
    first = f"named_struct('e', {e}, 'eta', {filtered('x', 'eta')}, 'kap', {filtered('1D', 'kap')})"
    second = f"named_struct('f', f, 'xi', {filtered('f.e', 'xi')}, 'r', array({', '.join([f's.eta[{i}]' for i in range(max_p)] + [f's.xi[{j}]' for j in range(max_q)] + ['f.kap', 'f.e'])}))"
    zeros = f"array_repeat(0D, {m})"
    start = f"named_struct('t', 0, 'w', {zeros}, 'e', {zeros}, 'eta', {zeros}, 'xi', {zeros}, 'kap', {zeros}, 'a', array_repeat(0D, {n * n}))"
    moved = ", ".join([f"'t', s.t + 1, 'w', {_push('x', 's.w', m)}, 'e', {_push('g.f.e', 's.e', m)}", f"'eta', {_push('g.f.eta', 's.eta', m)}",
                       f"'xi', {_push('g.xi', 's.xi', m)}", f"'kap', {_push('g.f.kap', 's.kap', m)}"])
    sums = f"CASE WHEN s.t < {m} THEN s.a ELSE transform(s.a, (v, i) -> v + g.r[i div {n}] * g.r[i % {n}]) END"
    step = (f"transform(transform(array({first}), f -> {second}), g -> named_struct({moved}, 'a', {sums}))[0]")
    normal = f"aggregate(_r_w, {start}, (s, x) -> {step}, s -> s.a)"

    def css(phi: str, theta: str, c: str) -> str:
        own = _recursion(max_p, max_q, phi, theta, c)
        return (f"aggregate(_r_w, named_struct('t', 0, 'w', {zeros}, 'e', {zeros}, 'q', 0D), (s, x) -> transform(array({own}), u -> "
                f"named_struct('t', s.t + 1, 'w', {_push('x', 's.w', m)}, 'e', {_push('u', 's.e', m)}, "
                f"'q', s.q + CASE WHEN s.t < {m} THEN 0D ELSE u * u END))[0])")

    return {"normal": normal, "css_before": css("_r_phi", "_r_theta", "c"), "css_after": css("_r_phi2", "_r_theta2", "_r_c2")}


def refine(fit, rel, G: Sequence[str], y: str, max_p: int = 3, max_q: int = 2, order: str = "period"):
    """Third Hannan-Rissanen step on a ``hannan_rissanen`` result: one Gauss-Newton step on the
    squared innovations, which takes away the bias of the two-step estimates.

    ``rel`` is the relation the fit came from. A step that does not lower the sum of squared innovations, or is not
    finite, is not taken (``refined`` false). Adds ``refined``; ``sigma2`` and the last innovations follow the
    new coefficients. Spark only; a series is one array here, so its length is bounded by a row."""
    from pyspark.sql import functions as F

    from panelcast.functions.dual import SparkRel
    from panelcast.functions.linalg import swept

    k, n = max_p + max_q + 1, max_p + max_q + 2
    text = refine_text(max_p, max_q)
    w = win(G, order)
    series = _keep(rel, [*G, order, y]).join(fit.select([(g, g) for g in G] + [("d", "d")]), list(G))
    series = series.stages([[("_h_w", f"CASE WHEN d = 1 THEN {y} - lag({y}, 1) {w} ELSE {y} END")]]).filter("_h_w IS NOT NULL")
    arrays = series.df.groupBy(*G).agg(F.expr(f"transform(array_sort(collect_list(struct({order} AS t, CAST(_h_w AS DOUBLE) AS w))), z -> z.w)").alias("_r_w"))
    out = SparkRel(fit.df.join(arrays, list(G)))
    out = out.stages([[("_r_phi", f"array({', '.join(f'phi{i + 1}' for i in range(max_p))})"),
                       ("_r_theta", f"array({', '.join(f'theta{j + 1}' for j in range(max_q))})")]])
    # parameters that the order does not have are no regressors
    on = [f"p > {i}" for i in range(max_p)] + [f"q > {j}" for j in range(max_q)] + ["d = 0", "TRUE"]
    on = f"array({', '.join(on)})"
    out = out.stages([[("_r_a", text["normal"])],
                      [("_r_a", f"transform(_r_a, (v, i) -> CASE WHEN {on}[i div {n}] AND {on}[i % {n}] THEN v ELSE 0D END)")],
                      [("_r_s", swept("_r_a", k, n))],
                      [("_r_phi2", f"transform(_r_phi, (v, i) -> v + _r_s[i * {n} + {k}])"),
                       ("_r_theta2", f"transform(_r_theta, (v, i) -> v + _r_s[(i + {max_p}) * {n} + {k}])"),
                       ("_r_c2", f"c + _r_s[{(k - 1) * n + k}]")],
                      [("_r_old", text["css_before"]), ("_r_new", text["css_after"])],
                      [("refined", "coalesce(_r_new.q < _r_old.q AND NOT isnan(_r_new.q), false)")]])
    better = [(f"phi{i + 1}", f"CASE WHEN refined THEN _r_phi2[{i}] ELSE phi{i + 1} END") for i in range(max_p)]
    better += [(f"theta{j + 1}", f"CASE WHEN refined THEN _r_theta2[{j}] ELSE theta{j + 1} END") for j in range(max_q)]
    better += [(f"e_t{j}", f"CASE WHEN refined THEN _r_new.e[{j}] ELSE e_t{j} END") for j in range(max_q)]
    better += [("c", "CASE WHEN refined THEN _r_c2 ELSE c END"),
               ("sigma2", f"CASE WHEN refined THEN _r_new.q / (_r_new.t - {max(max_p, max_q, 1)}) ELSE sigma2 END")]
    return out.replace([x for x in out.df.columns if x.startswith("_r_")], better)
