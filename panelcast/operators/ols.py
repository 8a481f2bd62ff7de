"""Ordinary least squares per series, as aggregates plus a tiny solve.

Data flow (no raw row ever leaves Spark's partitioning by series key):

1. ``prepare``: per-series standardisation of the regressors (window mean /
   population std over the complete rows) -- conditioning only; OLS with
   an intercept is invariant to it.
2. Sums ``n, S_j, Sy, Q_ij, Qy_j, Qyy`` over a frame: the whole series for
   the final fit (a ``groupBy(keys)``, partial + final aggregate) or, for the
   rolling-origin backtest, a RANGE window over the fold segment -- every
   fold's normal equations in one pass, no extra shuffle (SURVEY O4).
3. Centred system ``C b = c``: one packed array per row, solved by the sweep
   operator (``functions.linalg``); the oracle uses a Cholesky over named columns.
4. Residuals, Durbin-Watson, Newey-West (Bartlett) meat from ``lag`` windows
   over the estimation sample, sandwich ``B^-1 S B^-1`` (no small-sample
   correction, normal p-values), R^2, adjusted R^2, log-likelihood, AIC, BIC.

All kernels are SQL expression text run by ``SparkRel`` (``F.expr``) and,
for the oracle, by ``SqlRel`` in DuckDB.
"""

from __future__ import annotations

from collections.abc import Sequence

from panelcast.functions.dual import SparkRel, div, win
from panelcast.functions.linalg import cholesky_solve_stages, swept
from panelcast.plans.sqlbits import round_text

P = "_o"  # prefix of internal columns


def ok_expr(y: str, cols: Sequence[str]) -> str:
    parts = [f"{c} IS NOT NULL AND NOT isnan({c})" for c in [y, *cols]]
    return " AND ".join(f"({p})" for p in parts)


def prepare(rel, keys: Sequence[str], y: str, xs: Sequence[str], complete_cols: Sequence[str] = (),
            center: bool = True):
    """Flag complete rows and standardise regressors per series.

    ``center=False`` (models without intercept) only rescales by the root
    mean square, so the origin is kept.
    """
    d = rel.dialect
    okc = ok_expr(y, list(xs) + [c for c in complete_cols if c not in xs and c != y])
    st1 = [(f"{P}ok", f"({okc})")]
    w = win(keys)
    if center:
        st2 = [(f"{P}my", f"avg(CASE WHEN {P}ok THEN {y} END) {w}")]
        for j, x in enumerate(xs):
            st2.append((f"{P}mx{j}", f"avg(CASE WHEN {P}ok THEN {x} END) {w}"))
            st2.append((f"{P}sx{j}", f"stddev_pop(CASE WHEN {P}ok THEN {x} END) {w}"))
    else:
        st2 = [(f"{P}my", "0.0")]
        for j, x in enumerate(xs):
            st2.append((f"{P}mx{j}", "0.0"))
            st2.append((f"{P}sx{j}", f"sqrt(avg(CASE WHEN {P}ok THEN {x} * {x} END) {w})"))
    st3 = [(f"{P}ty", f"CASE WHEN {P}ok THEN {y} - {P}my END")]
    for j, x in enumerate(xs):
        # a constant column has no spread: 0, and the solve drops it
        st3.append((f"{P}t{j}", f"CASE WHEN {P}ok THEN coalesce({div(f'{x} - {P}mx{j}', f'{P}sx{j}', d)}, 0.0) END"))
    return rel.stages([st1, st2, st3])


def sum_exprs(k: int, over: str = "") -> list[tuple[str, str]]:
    """Normal-equation sums over complete rows (``over`` makes them windows)."""
    o = f" {over}" if over else ""
    out = [(f"{P}n", f"count(CASE WHEN {P}ok THEN 1 END){o}"),
           (f"{P}Sy", f"sum({P}ty){o}"), (f"{P}Qyy", f"sum({P}ty * {P}ty){o}")]
    for i in range(k):
        out.append((f"{P}S{i}", f"sum({P}t{i}){o}"))
        out.append((f"{P}Qy{i}", f"sum({P}t{i} * {P}ty){o}"))
        for j in range(i + 1):
            out.append((f"{P}Q{i}_{j}", f"sum({P}t{i} * {P}t{j}){o}"))
    return out


def _icpt(intercept: bool | str) -> str:
    if isinstance(intercept, str):
        return f"({intercept})"
    return "TRUE" if intercept else "FALSE"


def _centred(k: int, dialect: str, intercept: bool | str) -> tuple[dict[tuple[int, int], str], list[str], str]:
    """Texts of the centred cross-products (row k is y), of the regressors' means and of the mean of y."""
    n, ic = f"{P}n", _icpt(intercept)
    sums = [f"{P}S{i}" for i in range(k)] + [f"{P}Sy"]
    raw = {(i, j): f"{P}Q{i}_{j}" for i in range(k) for j in range(i + 1)}
    raw |= {(k, j): f"{P}Qy{j}" for j in range(k)} | {(k, k): f"{P}Qyy"}

    def less(i, j):
        return f"CASE WHEN {ic} THEN {div(f'{sums[i]} * {sums[j]}', n, dialect)} ELSE 0.0 END"

    means = [f"CASE WHEN {ic} THEN {div(x, n, dialect)} ELSE 0.0 END" for x in sums]
    return {ij: f"{q} - {less(*ij)}" for ij, q in raw.items()}, means[:k], means[k]


def packed_system(rel, k: int, active: Sequence[str] | None = None, intercept: bool | str = True):
    """Spark: the sums give way to one packed array ``_oA`` ((k + 1)^2 entries, the last row
    is y), the regressors' means ``_otb{j}`` and ``_oalpha``; ``_on, _oSy, _oQyy`` and other columns stay.

    ``active[j]`` (SQL boolean) switches regressor j off: its row and column are zero, so its pivot is dropped."""
    entry, means, alpha = _centred(k, rel.dialect, intercept)
    on = [f"({x})" for x in active] + ["TRUE"] if active is not None else None

    def at(i, j):
        text = f"CAST({entry[max(i, j), min(i, j)]} AS DOUBLE)"
        return text if on is None else f"CASE WHEN {on[i]} AND {on[j]} THEN {text} ELSE 0D END"

    gone = {n for n, _ in sum_exprs(k)} - {f"{P}n", f"{P}Sy", f"{P}Qyy"}
    return rel.replace(gone, [(f"{P}A", f"array({', '.join(at(i, j) for i in range(k + 1) for j in range(k + 1))})"),
                              *[(f"{P}tb{j}", m) for j, m in enumerate(means)], (f"{P}alpha", alpha)])


def solve(rel, k: int, active: Sequence[str] | None = None, intercept: bool | str = True, inverse: bool = False,
          batched: bool = False):
    """Sums -> coefficients ``_ob{j}``, means ``_otb{j}`` and intercept ``_oalpha`` of
    ``ty = alpha + sum b_j (t_j - tbar_j)``, the residual sum of squares ``_ossr`` and, with
    ``inverse``, ``_oCi{i}_{j}`` (i <= j); ``_on, _oSy, _oQyy`` and other columns stay.

    ``active[j]`` (SQL boolean) switches regressor j off: ``b_j = 0`` and the others
    solve the reduced system exactly -- many models from one set of
    sums. ``intercept=False`` uses the uncentred moments. ``batched`` (Spark): many
    systems, solved a batch of rows at once."""
    if rel.dialect != "spark":
        rel = rel.stages(_staged_solve(k, rel.dialect, active, intercept, inverse))
        return rel.stages(_staged_ssr(k, rel.dialect, intercept)).drop(_scratch(k))
    n = k + 1
    rel = packed_system(rel, k, active, intercept)
    rel = rel.swept(f"{P}A", f"{P}W", k, n) if batched else rel.replace([f"{P}A"], [(f"{P}W", swept(f"{P}A", k, n))])
    found = [(f"{P}b{j}", f"{P}W[{j * n + k}]") for j in range(k)] + [(f"{P}ssr", f"greatest({P}W[{n * n - 1}], 0D)")]
    if inverse:
        found += [(f"{P}Ci{i}_{j}", f"-{P}W[{i * n + j}]") for i in range(k) for j in range(i, k)]
    return rel.replace([f"{P}W"], found)


def _staged_solve(k: int, dialect: str, active: Sequence[str] | None, intercept: bool | str, inverse: bool):
    """Cholesky stages over named columns (the oracle's form of ``solve``)."""
    entry, means, alpha = _centred(k, dialect, intercept)
    on = (lambda j: f"({active[j]})") if active is not None else (lambda j: "TRUE")
    cen = []
    for i in range(k):
        cen.append((f"{P}tb{i}", means[i]))
        cen.append((f"{P}c{i}", f"CASE WHEN {on(i)} THEN {entry[k, i]} ELSE 0.0 END"))
        for j in range(i + 1):
            other = "1.0" if i == j else "0.0"
            cen.append((f"{P}C{i}_{j}", f"CASE WHEN {on(i)} AND {on(j)} THEN {entry[i, j]} ELSE {other} END"))
    cen.append((f"{P}alpha", alpha))
    C = lambda i, j: f"{P}C{max(i, j)}_{min(i, j)}"
    return [cen] + cholesky_solve_stages(C, lambda i: f"{P}c{i}", k, P, lambda i: f"{P}b{i}", dialect,
                                         (lambda i, j: f"{P}Ci{i}_{j}") if inverse else None)


def _staged_ssr(k: int, dialect: str, intercept: bool | str) -> list:
    syy = _centred(k, dialect, intercept)[0][k, k]
    bc = " + ".join(f"{P}b{j} * {P}c{j}" for j in range(k)) or "0.0"
    return [[(f"{P}ssr", f"greatest(({syy}) - ({bc}), 0.0)")]]


def _scratch(k: int) -> list[str]:
    """Names a staged solve leaves behind that later steps never read."""
    names = [f"{P}{c}_{i}_{j}" for c in "LM" for i in range(k) for j in range(i + 1)]
    names += [f"{P}{c}{i}_{j}" for c in "CQ" for i in range(k) for j in range(i + 1)]
    return names + [f"{P}{c}{i}" for c in ("z_", "Qy", "S", "c") for i in range(k)]


def solution_columns(k: int) -> list[str]:
    """Columns of a solved system that a prediction needs."""
    return [f"{P}alpha"] + [f"{P}{nm}{j}" for j in range(k) for nm in ("b", "tb")]


def fitted_expr(k: int) -> str:
    """Prediction in original units from the standardised solution."""
    terms = " + ".join(f"{P}b{j} * ({P}t{j} - {P}tb{j})" for j in range(k)) or "0.0"
    return f"{P}my + {P}alpha + {terms}"


def _shift(j: int, dialect: str) -> str:
    """mx_j / sx_j; 0 for a constant column, whose coefficient is 0."""
    return f"coalesce({div(f'{P}mx{j}', f'{P}sx{j}', dialect)}, 0.0)"


def coef_exprs(k: int, dialect: str) -> list[tuple[str, str]]:
    """Original-unit coefficients: b_j / sx_j and the intercept."""
    out = [(f"{P}beta{j}", f"coalesce({div(f'{P}b{j}', f'{P}sx{j}', dialect)}, 0.0)") for j in range(k)]
    # intercept: my + alpha - sum b_j * (tbar_j + mx_j / sx_j)
    r = " + ".join(f"{P}b{j} * ({P}tb{j} + {_shift(j, dialect)})" for j in range(k)) or "0.0"
    out.append((f"{P}beta_const", f"{P}my + {P}alpha - ({r})"))
    return out


# ---------------------------------------------------------------- backtest
def positions(rel, keys: Sequence[str], n_folds: int, horizon: int, order: str = "period"):
    """``pos``, ``n_rows`` and fold segment ``seg`` (-1 before the first test)."""
    K, h = int(n_folds), int(horizon)
    st1 = [("pos", f"CAST(row_number() {win(keys, order)} - 1 AS BIGINT)"),
           ("n_rows", f"CAST(count(*) {win(keys)} AS BIGINT)")]
    st2 = [("seg", f"CAST(CASE WHEN pos >= n_rows - {K * h} THEN {K} - CAST(ceil((n_rows - pos) / {float(h)}) AS BIGINT) ELSE -1 END AS BIGINT)")]
    return rel.stages([st1, st2]).filter(f"n_rows >= {(K + 1) * h}")


def backtest_predictions(rel, keys: Sequence[str], y: str, xs: Sequence[str], n_folds: int = 5,
                         horizon: int = 6, complete_cols: Sequence[str] = (), min_train: int = 10,
                         model: str = "OLS"):
    """Test-row predictions ``(keys, model, fold_idx, period, y_true, y_pred)``.

    Fold f trains on complete rows with segment < f: the sums are grouped per
    (series, segment), a RANGE frame over the segments adds up those before
    f, the system is solved once per fold and joined to the fold's test rows.
    Folds with fewer than ``min_train`` complete training rows are skipped.
    """
    d = rel.dialect
    k = len(xs)
    r = positions(rel, keys, n_folds, horizon)
    r = prepare(r, keys, y, xs, complete_cols).filter(f"{P}ok").share()
    g = r.group(list(keys) + ["seg"], sum_exprs(k))
    frame = win(keys, "seg", "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    g = g.select([(c, c) for c in keys] + [("seg", "seg")] + [(n, f"sum({n}) {frame}") for n, _ in sum_exprs(k)])
    g = g.filter(f"seg >= 0 AND {P}n >= {int(min_train)}")
    g = solve(g, k)
    g = g.select([(c, c) for c in keys] + [("seg", "seg")] + [(c, c) for c in solution_columns(k)])
    r = r.filter("seg >= 0").join(g, list(keys) + ["seg"])
    cols = [(c, c) for c in keys] + [("model", f"'{model}'"), ("fold_idx", "CAST(seg AS INT)"),
                                      ("period", "period"), ("y_true", y), ("y_pred", fitted_expr(k))]
    return r.select(cols)


def naive_backtest_predictions(rel, keys: Sequence[str], y: str, n_folds: int = 5, horizon: int = 6,
                               complete_cols: Sequence[str] = (), min_train: int = 10, model: str = "naive"):
    """Last complete training value repeated over the test window."""
    r = positions(rel, keys, n_folds, horizon)
    okc = ok_expr(y, complete_cols)
    r = r.stages([[(f"{P}ok", f"({okc})")]])
    frame = win(keys, "seg", "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    r = r.stages([[(f"{P}last", f"max_by(CASE WHEN {P}ok THEN {y} END, CASE WHEN {P}ok THEN pos END) {frame}"),
                   (f"{P}n", f"count(CASE WHEN {P}ok THEN 1 END) {frame}")]])
    r = r.filter(f"seg >= 0 AND {P}ok AND {P}n >= {int(min_train)}")
    cols = [(c, c) for c in keys] + [("model", f"'{model}'"), ("fold_idx", "CAST(seg AS INT)"),
                                      ("period", "period"), ("y_true", y), ("y_pred", f"{P}last")]
    return r.select(cols)


def _pick(rel, cols: Sequence[str]):
    return rel.select([(c, c) for c in cols])


# ---------------------------------------------------------------- full fit
def fit(rel, keys: Sequence[str], y: str, xs: Sequence[str], hac_lags: int = 6,
        complete_cols: Sequence[str] = ()):
    """Full-sample fit per series -> one row per series with every statistic.

    Columns: ``coef_<term>``, ``se_<term>``, ``z_<term>``, ``p_<term>`` for
    ``const`` and each regressor, ``n_obs``, ``r2``, ``adj_r2``, ``ssr``,
    ``llf``, ``aic``, ``bic``, ``durbin_watson``, ``hac_lags``.
    """
    d = rel.dialect
    k = len(xs)
    L = int(hac_lags)
    r = prepare(rel, keys, y, xs, complete_cols).filter(f"{P}ok").share()
    # sums and one solve per series, then back to the rows on the same partitioning
    first = "first" if d == "spark" else "any_value"
    scale = [f"{P}my"] + [f"{P}{nm}{j}" for j in range(k) for nm in ("mx", "sx")]
    solved = r.group(list(keys), sum_exprs(k) + [(c, f"{first}({c})") for c in scale])
    solved = solve(solved, k, inverse=True).drop([f"{P}ssr"]).share()
    r = _pick(r, list(keys) + ["period", f"{P}ty"] + [f"{P}t{j}" for j in range(k)]).join(
        _pick(solved, list(keys) + solution_columns(k)), list(keys))
    resid = " + ".join(f"{P}b{j} * ({P}t{j} - {P}tb{j})" for j in range(k)) or "0.0"
    r = r.stages([[(f"{P}g0", f"{P}ty - ({P}alpha + {resid})")]])
    r = r.stages([[(f"{P}g{j + 1}", f"{P}g0 * ({P}t{j} - {P}tb{j})") for j in range(k)]])
    wt = win(keys, "period")
    lags = [(f"{P}du", f"{P}g0 - lag({P}g0, 1) {wt}")]
    for l in range(1, L + 1):
        for a in range(k + 1):
            lags.append((f"{P}g{a}_l{l}", f"lag({P}g{a}, {l}) {wt}"))
    r = r.stages([lags])
    meat = []
    for a in range(k + 1):
        for b in range(a + 1):
            terms = [f"{P}g{a} * {P}g{b}"]
            for l in range(1, L + 1):
                wl = 1.0 - l / (L + 1.0)
                terms.append(f"{wl!r} * (coalesce({P}g{a} * {P}g{b}_l{l}, 0.0) + coalesce({P}g{a}_l{l} * {P}g{b}, 0.0))")
            meat.append((f"{P}H{a}_{b}", f"sum({' + '.join(terms)})"))
    aggs = meat + [(f"{P}ssr", f"sum({P}g0 * {P}g0)"), (f"{P}dwn", f"sum({P}du * {P}du)")]
    r = r.group(list(keys), aggs).join(solved, list(keys))
    r = r.stages([coef_exprs(k, d)])
    r = r.stages(_sandwich_stages(k, d, robust=L > 0))
    r = r.stages(_fit_stat_stages(k, d))
    return r


def _Ci(i, j):
    return f"{P}Ci{min(i, j)}_{max(i, j)}"


def _H(a, b):
    return f"{P}H{max(a, b)}_{min(a, b)}"


def _sandwich_stages(k: int, d: str, robust: bool):
    """Variances of (alpha, b~) then of the original-unit coefficients."""
    n = f"{P}n"
    st, half = [], []
    if robust:
        # theta = (alpha, b~); B^-1 = diag(1/n, Ci); S = H (index 0 = constant)
        st.append((f"{P}V0_0", div(_H(0, 0), f"{n} * {n}", d)))
        for j in range(k):
            s = " + ".join(f"{_H(0, m + 1)} * {_Ci(m, j)}" for m in range(k))
            st.append((f"{P}V0_{j + 1}", div(s, n, d)))
        # Ci H Ci as two products, so the text grows with k^3
        half = [(f"{P}W{i}_{b}", " + ".join(f"{_Ci(i, a)} * {_H(a + 1, b + 1)}" for a in range(k)))
                for i in range(k) for b in range(k)]
        for i in range(k):
            for j in range(i, k):
                st.append((f"{P}V{i + 1}_{j + 1}", " + ".join(f"{P}W{i}_{b} * {_Ci(b, j)}" for b in range(k))))
    else:
        s2 = div(f"{P}ssr", f"{n} - {k + 1}", d)
        st.append((f"{P}V0_0", div(s2, n, d)))
        for j in range(k):
            st.append((f"{P}V0_{j + 1}", "0.0"))
        for i in range(k):
            for j in range(i, k):
                st.append((f"{P}V{i + 1}_{j + 1}", f"({s2}) * {_Ci(i, j)}"))
    V = lambda a, b: f"{P}V{min(a, b)}_{max(a, b)}"
    rj = [f"({P}tb{j} + {_shift(j, d)})" for j in range(k)]
    var_c = [V(0, 0)]
    for j in range(k):
        var_c.append(f"- 2.0 * {rj[j]} * {V(0, j + 1)}")
    for i in range(k):
        for j in range(k):
            var_c.append(f"+ {rj[i]} * {rj[j]} * {V(i + 1, j + 1)}")
    se = [(f"{P}se_const", f"CASE WHEN ({' '.join(var_c)}) >= 0 THEN sqrt({' '.join(var_c)}) END")]
    for j in range(k):
        se.append((f"{P}se{j}", div(f"CASE WHEN {V(j + 1, j + 1)} >= 0 THEN sqrt({V(j + 1, j + 1)}) END", f"{P}sx{j}", d)))
    return ([half] if half else []) + [st, se]


def _fit_stat_stages(k: int, d: str):
    n = f"{P}n"
    sst = f"({P}Qyy - {div(f'{P}Sy * {P}Sy', n, d)})"
    st = [(f"{P}r2", f"1.0 - {div(f'{P}ssr', sst, d)}"),
          (f"{P}llf", f"-{n} / 2.0 * (ln(2.0 * pi()) + ln(CASE WHEN {P}ssr > 0 THEN {div(f'{P}ssr', n, d)} END) + 1.0)"),
          (f"{P}dw", div(f"{P}dwn", f"{P}ssr", d))]
    st2 = [(f"{P}adj_r2", f"1.0 - (1.0 - {P}r2) * {div(f'{n} - 1.0', f'{n} - {k + 1}.0', d)}"),
           (f"{P}aic", f"-2.0 * {P}llf + 2.0 * {k + 1}"),
           (f"{P}bic", f"-2.0 * {P}llf + {k + 1} * ln({n})")]
    return [st, st2]


def normal_p_stages(z: str, p: str) -> list:
    """Two-sided normal p-value of column ``z`` into column ``p``, staged so
    each piece is a column (keeps generated code small; both engines).
    Abramowitz-Stegun 7.1.26 erf approximation, |error| <= 1.5e-7."""
    from panelcast.functions.columns import AS_A, AS_P
    x, t = f"{p}_x", f"{p}_t"
    poly = f"{t} * ({AS_A[0]!r} + {t} * ({AS_A[1]!r} + {t} * ({AS_A[2]!r} + {t} * ({AS_A[3]!r} + {t} * {AS_A[4]!r}))))"
    return [[(x, f"abs({z}) / sqrt(2.0)")],
            [(t, f"1.0 / (1.0 + {AS_P!r} * {x})")],
            # 2 * (1 - Phi(|z|)) = 1 - erf(|z|/sqrt 2) = poly * exp(-x^2)
            [(p, f"{poly} * exp(-{x} * {x})")]]


def student_p(t: str, df: str, dialect: str) -> str:
    """Two-sided Student-t p-value for whole degrees of freedom, by the finite
    series in the angle (Abramowitz & Stegun 26.7.3 and 26.7.4).

    Spark adds the terms up with their ratio, DuckDB takes each from gamma functions."""
    cos2 = f"({df} / ({df} + ({t}) * ({t})))"
    sine = f"sqrt(1.0 - {cos2})"
    angle = f"atan(abs({t}) / sqrt({df}))"
    odd = f"({df} % 2 = 1)"
    last = f"CAST(CASE WHEN {odd} THEN ({df} - 3) / 2 ELSE ({df} - 2) / 2 END AS INT)"
    if dialect == "spark":
        ratio = f"(CASE WHEN {odd} THEN 2D * k / (2D * k + 1D) ELSE (2D * k - 1D) / (2D * k) END) * {cos2}"
        total = (f"aggregate(CASE WHEN {last} < 1 THEN CAST(array() AS ARRAY<INT>) ELSE sequence(1, {last}) END, "
                 f"named_struct('u', 1D, 's', 1D), (a, k) -> named_struct('u', a.u * {ratio}, 's', a.s + a.u * {ratio}), a -> a.s)")
    else:
        term = (f"exp((CASE WHEN {odd} THEN lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5) "
                f"ELSE lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1) END) + k * ln({cos2}))")
        total = f"list_sum(list_transform(range(0, {last} + 1), lambda k: {term}))"
    inside = (f"CASE WHEN {df} = 1 THEN 2.0 * {angle} / pi() "
              f"WHEN {odd} THEN 2.0 / pi() * ({angle} + {sine} * sqrt({cos2}) * {total}) ELSE {sine} * {total} END")
    return f"CASE WHEN ({t}) IS NOT NULL AND {df} >= 1 THEN greatest(0.0, 1.0 - ({inside})) END"


def coefficient_table(rel, keys: Sequence[str], xs: Sequence[str], dp: int = 6, robust: bool = True):
    """Long ``(keys, term, coef, std_err, z_stat, p_value, stars)``.

    Robust (HAC) errors take normal p-values; a fit without them
    (``hac_lags=0``, ``robust=False``) the Student-t ones."""
    d = rel.dialect
    terms = [("const", f"{P}beta_const", f"{P}se_const")] + [(x, f"{P}beta{j}", f"{P}se{j}") for j, x in enumerate(xs)]
    zst = [[(f"{P}zs_{i}", div(cb, cs, d)) for i, (_, cb, cs) in enumerate(terms)]]
    pst = [[], [], []] if robust else [[(f"{P}df", f"CAST({P}n - {len(xs) + 1} AS DOUBLE)")], []]
    for i in range(len(terms)):
        if robust:
            for lvl, st in enumerate(normal_p_stages(f"{P}zs_{i}", f"{P}p_{i}")):
                pst[lvl] += st
        else:
            pst[1].append((f"{P}p_{i}", student_p(f"{P}zs_{i}", f"{P}df", d)))
    rel = rel.stages(zst + pst)
    parts = []
    for i, (name, cb, cs) in enumerate(terms):
        p = f"{P}p_{i}"
        parts.append([(kk, kk) for kk in keys] + [
            ("term", f"'{name}'"), ("coef", round_text(cb, dp)), ("std_err", round_text(cs, dp)),
            ("z_stat", f"round({P}zs_{i}, {dp - 2})"), ("p_value", round_text(p, dp)),
            ("stars", f"CASE WHEN {p} < 0.01 THEN '***' WHEN {p} < 0.05 THEN '**' WHEN {p} < 0.1 THEN '*' ELSE '' END")])
    return union_selects(rel, parts)


def union_selects(rel, parts):
    """Several projections of one relation stacked as rows.

    Spark: one ``explode(array(named_struct...))`` so the relation is
    computed once; DuckDB: UNION ALL of the projections.
    """
    from panelcast.plans.sqlbits import rewrite_round
    if isinstance(rel, SparkRel):
        from pyspark.sql import functions as F
        names = [n for n, _ in parts[0]]
        structs = [F.struct(*[F.expr(rewrite_round(e)).alias(n) for n, e in cols]) for cols in parts]
        out = rel.df.select(F.explode(F.array(*structs)).alias("_r")).select(*[F.col(f"_r.{n}").alias(n) for n in names])
        return SparkRel(out)
    rel = rel.share()
    return rel._new(" UNION ALL ".join(f"({rel.select(cols).body})" for cols in parts))


def fit_stats_table(rel, keys: Sequence[str], dp: int = 6):
    cols = [(kk, kk) for kk in keys] + [
        ("n_obs", f"CAST({P}n AS BIGINT)"), ("r2", f"round({P}r2, {dp})"), ("adj_r2", f"round({P}adj_r2, {dp})"),
        ("aic", f"round({P}aic, {dp - 2})"), ("bic", f"round({P}bic, {dp - 2})"),
        ("llf", f"round({P}llf, {dp - 2})"), ("durbin_watson", f"round({P}dw, {dp})")]
    return rel.select(cols)
