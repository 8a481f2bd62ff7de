"""Small dense linear algebra as column expressions.

A k x k symmetric positive-definite system (k = number of regressors, a
dozen) is solved once per row, no Python. Two independent forms:

* Spark: the system with its right-hand side is one packed ``ARRAY<DOUBLE>``
  of (k + 1)^2 entries; ``swept`` pivots on one regressor after the other
  (the sweep operator). After the pivots 0 .. m the array holds the solution,
  the residual sum of squares and the inverse of the model with those
  regressors, so one pass gives all nested models (``swept_path``). Where there are many systems
  (a grid of orders per series and fold), ``sweeper`` does the same steps for a batch of rows at once.
* DuckDB (the oracle): an unrolled Cholesky factorisation ``C = L L'``, one
  column of L per projection, over named columns.

A pivot below ``PIVOT_TOL`` times its diagonal (a constant regressor, or one that
others explain) drops its regressor: its solution is 0 and the others solve the
reduced system, instead of amplifying rounding noise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

Stage = list[tuple[str, str]]

# A pivot below this fraction of its diagonal entry means the regressors
# are (numerically) collinear; the same in Spark and in the oracle.
PIVOT_TOL = 1e-10


def div(a: str, b: str, dialect: str) -> str:
    if dialect == "spark":
        return f"try_divide(({a}), ({b}))"
    return f"(({a}) / nullif(({b}), 0))"


def _sum(terms: Sequence[str]) -> str:
    return " + ".join(f"({t})" for t in terms) if terms else "0.0"


def sweep(a: str, p: str, diagonal: str, n: int) -> str:
    """Spark text: the packed symmetric n x n array ``a`` swept on pivot ``p``.

    Swept: the pivot becomes -1/d, its row and column are divided by d, the rest
    is reduced. A pivot too small against ``diagonal`` has its row and column zeroed."""
    d = f"{a}[{p} * {n + 1}]"
    mine = f"(i div {n} = {p} OR i % {n} = {p})"
    return (f"transform({a}, (v, i) -> CASE WHEN NOT coalesce({d} > {PIVOT_TOL!r} * abs({diagonal}[{p} * {n + 1}]), false) "
            f"THEN CASE WHEN {mine} THEN 0D ELSE v END "
            f"WHEN i = {p} * {n + 1} THEN -1D / {d} WHEN {mine} THEN v / {d} "
            f"ELSE v - {a}[(i div {n}) * {n} + {p}] * {a}[{p} * {n} + i % {n}] / {d} END)")


def swept(a: str, pivots: int, n: int) -> str:
    """Spark text: ``a`` swept on the pivots 0 .. pivots - 1."""
    if not pivots:
        return a
    return f"aggregate(sequence(0, {pivots - 1}), {a}, (s, p) -> {sweep('s', 'p', a, n)})"


def swept_path(a: str, pivots: int, n: int, kept: dict[str, int]) -> str:
    """Spark text: an array with one struct per pivot count 1 .. pivots: the entries ``kept`` (name -> place
    in the packed array) after that many pivots, all nested models from one pass."""
    fields = ", ".join(f"'{name}', x[{at}]" for name, at in kept.items())
    kind = f"ARRAY<STRUCT<{', '.join(f'{name}: DOUBLE' for name in kept)}>>"
    return (f"aggregate(sequence(0, {pivots - 1}), named_struct('a', {a}, 'found', CAST(array() AS {kind})), (s, p) -> "
            f"transform(array({sweep('s.a', 'p', a, n)}), x -> named_struct('a', x, 'found', "
            f"concat(s.found, array(named_struct({fields})))))[0], s -> s.found)")


def sweep_batch(a: np.ndarray, pivots: int, kept: Sequence[int] = ()) -> np.ndarray:
    """``swept`` for many systems at once (``a``: rows x n x n, without nulls), with the same
    arithmetic in the same order; with ``kept``, those places after each pivot, pivot by pivot (``swept_path``)."""
    m, n, _ = a.shape
    diagonal, path = np.abs(np.einsum("bii->bi", a)), []
    with np.errstate(all="ignore"):
        for p in range(pivots):
            row, col, least = a[:, p, :].copy(), a[:, :, p].copy(), PIVOT_TOL * diagonal[:, p]
            d = row[:, p]
            used = (d > least) | (np.isnan(d) & ~np.isnan(least))  # in SQL, NaN is above every number
            by = d[:, None]
            new = a - col[:, :, None] * row[:, None, :] / d[:, None, None]
            new[:, p, :], new[:, :, p], new[:, p, p] = row / by, col / by, -1.0 / d
            gone = a[~used]
            gone[:, p, :] = gone[:, :, p] = 0.0
            new[~used] = gone
            a = new
            path.append(a.reshape(m, n * n)[:, list(kept)])
    return np.concatenate(path, axis=1) if kept else a.reshape(m, n * n)


@cache
def sweeper(pivots: int, n: int, kept: tuple[int, ...] = ()):
    """``sweep_batch`` as a column function over packed systems."""
    def run(packed: pa.Array) -> pa.Array:
        systems = packed.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n, n)
        out = sweep_batch(systems, pivots, kept)  # as Arrow, not pandas, which would take NaN for null
        return pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1], pa.array(out.ravel(), from_pandas=False))

    return F.arrow_udf(run, "array<double>")


def cholesky_solve_stages(C: Callable[[int, int], str], rhs: Callable[[int], str], k: int, p: str,
                          out: Callable[[int], str], dialect: str,
                          inv_out: Callable[[int, int], str] | None = None,
                          inv_pairs: Sequence[tuple[int, int]] | None = None) -> list[Stage]:
    """Solve ``C b = rhs``; ``b_i`` named ``out(i)``, ``(C^-1)_ij`` (i <= j, or
    only ``inv_pairs``) named ``inv_out(i, j)`` when given."""
    L = lambda i, j: f"{p}L_{i}_{j}"
    M = lambda i, j: f"{p}M_{i}_{j}"
    z = lambda i: f"{p}z_{i}"
    stages: list[Stage] = []

    def per(a: str, b: str) -> str:
        return f"coalesce({div(a, b, dialect)}, 0.0)"  # 0 where the pivot was dropped

    for j in range(k):
        piv = f"{C(j, j)} - ({_sum([f'{L(j, m)} * {L(j, m)}' for m in range(j)])})"
        ljj = f"(CASE WHEN ({piv}) > {PIVOT_TOL!r} * abs({C(j, j)}) THEN sqrt({piv}) END)"
        st = [(L(j, j), ljj)]
        for i in range(j + 1, k):
            num = f"{C(i, j)} - ({_sum([f'{L(i, m)} * {L(j, m)}' for m in range(j)])})"
            st.append((L(i, j), per(num, ljj)))
        st.append((z(j), per(f"{rhs(j)} - ({_sum([f'{L(j, m)} * {z(m)}' for m in range(j)])})", ljj)))
        st.append((M(j, j), per("1.0", ljj)))
        for m in range(j):
            st.append((M(j, m), per(f"-({_sum([f'{L(j, r)} * {M(r, m)}' for r in range(m, j)])})", ljj)))
        stages.append(st)
    last = [(out(i), _sum([f"{M(m, i)} * {z(m)}" for m in range(i, k)])) for i in range(k)]
    if inv_out is not None:
        for i, j in inv_pairs or [(i, j) for i in range(k) for j in range(i, k)]:
            last.append((inv_out(i, j), _sum([f"{M(m, i)} * {M(m, j)}" for m in range(j, k)])))
    stages.append(last)
    return stages
