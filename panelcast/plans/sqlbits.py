"""Rounding shared by the Spark queries and their SQL twins.

Spark's ``round`` rounds the *decimal text* of a double half-up, DuckDB's
rounds the *binary* product ``x * 10^d`` half away from zero; on exact
ties (an interpolated half cent) they differ. Outputs are therefore rounded
with the same arithmetic in both engines: ``floor(|x| * 10^d + 0.5) / 10^d``
with the sign restored. Values beyond 1e15 are left as they are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places used in both engines so that float results compare equal.
MONEY_DP = 2
RATIO_DP = 6
_BIG = 1e15


def rnd(col, dp: int = RATIO_DP) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s = float(10 ** dp)
    r = F.when(c < 0, -F.floor(-c * s + 0.5)).otherwise(F.floor(c * s + 0.5)) / F.lit(s)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) >= _BIG), c).otherwise(r)


def round_text(expr: str, dp: int) -> str:
    """The same rounding as SQL text (valid in Spark SQL and DuckDB)."""
    s = repr(float(10 ** dp))
    x = f"({expr})"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) >= {_BIG!r} THEN {x} "
            f"WHEN {x} < 0 THEN -floor(-{x} * {s} + 0.5) / {s} ELSE floor({x} * {s} + 0.5) / {s} END)")


_ROUND = re.compile(r"\bround\(", re.IGNORECASE)


def rewrite_round(sql: str) -> str:
    """Replace every ``round(expr, d)`` in ``sql`` with ``round_text``."""
    out, i = [], 0
    while True:
        m = _ROUND.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:m.start()])
        j, depth, comma = m.end(), 1, None
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner_expr = rewrite_round(sql[m.end():comma])
        dp = int(sql[comma + 1:j - 1].strip())
        out.append(round_text(inner_expr, dp))
        i = j


def filled_sql(src: str, keys: str, col: str, threshold: float = 5.0) -> str:
    """The imputation policy as SQL over a gridded series."""
    part = f"PARTITION BY {keys}"
    past = f"OVER ({part} ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER ({part} ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""SELECT {keys}, period, CASE WHEN pct = 0 THEN {col} WHEN pct <= {threshold} THEN coalesce(pv, nv)
  ELSE coalesce({col}, CASE WHEN nv IS NULL THEN pv WHEN pv IS NOT NULL THEN
       pv + (nv - pv) * (CAST(date_diff('day', pt, period) AS DOUBLE) / date_diff('day', pt, nt)) END, nv) END AS {col}
FROM (SELECT *, round(100.0 * avg(CASE WHEN {col} IS NULL THEN 1.0 ELSE 0.0 END) OVER ({part}), 2) AS pct,
       last_value({col} IGNORE NULLS) {past} AS pv, last_value(CASE WHEN {col} IS NOT NULL THEN period END IGNORE NULLS) {past} AS pt,
       first_value({col} IGNORE NULLS) {ahead} AS nv, first_value(CASE WHEN {col} IS NOT NULL THEN period END IGNORE NULLS) {ahead} AS nt
     FROM ({src}) g) x"""
