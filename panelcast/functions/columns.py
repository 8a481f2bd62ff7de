"""Scalar column functions used across the operators.

All of them return ``pyspark.sql.Column`` built from built-in functions, so
they run inside whole-stage codegen and need no Python worker.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FREQS = ("month", "day", "hour")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_of(ts, freq: str = "month") -> Column:
    """Normalise a timestamp/date to the start of its period.

    month -> DATE of the first day; day -> DATE; hour -> TIMESTAMP_NTZ.
    ``trunc`` works on DATE and keeps the type, unlike ``date_trunc`` on
    TIMESTAMP_NTZ which returns a session-zone TIMESTAMP.
    """
    c = _c(ts)
    if freq == "month":
        return F.trunc(F.to_date(c), "MM")
    if freq == "day":
        return F.to_date(c)
    if freq == "hour":
        return F.date_trunc("HOUR", c.cast("timestamp_ntz")).cast("timestamp_ntz")
    raise ValueError(f"unknown freq {freq!r}; expected one of {FREQS}")


def step_interval(freq: str = "month") -> Column:
    """Interval literal of one period, for ``sequence``."""
    if freq == "month":
        return F.expr("INTERVAL 1 MONTH")
    if freq == "day":
        return F.expr("INTERVAL 1 DAY")
    if freq == "hour":
        return F.expr("INTERVAL 1 HOUR")
    raise ValueError(f"unknown freq {freq!r}")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (dates or times), whatever the session's time zone."""
    def of_day(c):
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return (F.datediff(end, start).cast("bigint") * 86400 + of_day(end) - of_day(start)).cast("double")


def add_periods(col, n, freq: str = "month") -> Column:
    """``col`` shifted by ``n`` periods (``n`` an int or an integer column)."""
    c = _c(col)
    nn = n if isinstance(n, Column) else F.lit(int(n))
    if freq == "month":
        return F.add_months(c, nn)
    if freq == "day":
        return F.date_add(c, nn)
    if freq == "hour":
        return (c + F.make_dt_interval(F.lit(0), nn)).cast("timestamp_ntz")
    raise ValueError(f"unknown freq {freq!r}")


def period_bounds(start, end, freq: str = "month"):
    """Raw-time bounds ``[lo, hi)`` of all periods ``p`` with start <= p <= end.

    Computed on the driver from two literals, so the resulting predicate is
    on the raw time column and reaches the Parquet scan (PushedFilters).
    """
    lo = hi = None
    if start is not None:
        s = _to_datetime(start)
        if freq == "month":
            lo = s if (s.day == 1 and s.time() == _dt.time()) else _first_of_next_month(s)
        elif freq == "day":
            lo = s if s.time() == _dt.time() else _dt.datetime.combine(s.date() + _dt.timedelta(days=1), _dt.time())
        else:
            lo = s if (s.minute, s.second, s.microsecond) == (0, 0, 0) else s.replace(minute=0, second=0, microsecond=0) + _dt.timedelta(hours=1)
    if end is not None:
        e = _to_datetime(end)
        if freq == "month":
            hi = _first_of_next_month(e.replace(day=1, hour=0, minute=0, second=0, microsecond=0))
        elif freq == "day":
            hi = _dt.datetime.combine(e.date() + _dt.timedelta(days=1), _dt.time())
        else:
            hi = e.replace(minute=0, second=0, microsecond=0) + _dt.timedelta(hours=1)
    return lo, hi


def _to_datetime(x) -> _dt.datetime:
    if isinstance(x, _dt.datetime):
        return x
    if isinstance(x, _dt.date):
        return _dt.datetime.combine(x, _dt.time())
    return _dt.datetime.fromisoformat(str(x))


def _first_of_next_month(d: _dt.datetime) -> _dt.datetime:
    y, m = (d.year + 1, 1) if d.month == 12 else (d.year, d.month + 1)
    return _dt.datetime(y, m, 1)


def is_finite(col) -> Column:
    """Not NULL, not NaN and not +/-Infinity."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def normal_cdf(z) -> Column:
    """Standard normal CDF from the Abramowitz-Stegun 7.1.26 erf approximation.

    |error| <= 1.5e-7, enough for p-values reported to four decimals.
    """
    z = _c(z)
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * x)
    poly = t * (F.lit(AS_A[0]) + t * (F.lit(AS_A[1]) + t * (F.lit(AS_A[2]) + t * (F.lit(AS_A[3]) + t * F.lit(AS_A[4])))))
    erf_abs = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, F.lit(0.5) * (F.lit(1.0) + erf_abs)).otherwise(F.lit(0.5) * (F.lit(1.0) - erf_abs))


def normal_two_sided_p(z) -> Column:
    """Two-sided p-value of a z statistic: 2 * (1 - Phi(|z|))."""
    z = _c(z)
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(z)))


# Abramowitz & Stegun (1964) formula 7.1.26 coefficients.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def significance_stars(p) -> Column:
    """'***' p<0.01, '**' p<0.05, '*' p<0.10, else ''."""
    p = _c(p)
    return (F.when(p < 0.01, "***").when(p < 0.05, "**").when(p < 0.10, "*").otherwise(""))


def fmt_fixed(col, decimals: int = 4, missing: str = "N/A") -> Column:
    """Fixed-decimal text; missing (NULL or NaN) renders as ``missing``."""
    c = _c(col)
    return F.when(c.isNull() | F.isnan(c), F.lit(missing)).otherwise(F.format_string(f"%.{decimals}f", c))
