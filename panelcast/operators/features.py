"""Leakage-free feature operators over panels.

All windows share ``Window.partitionBy(keys).orderBy(period)``; Catalyst
puts every lag and frame over that spec into one exchange + one sort, and
at most two Window nodes (the change target, then its lags/rolls).
Frames are ROWS frames: position t-k..t-1, so a rolling statistic never
sees the current row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.calendar import PERIOD, _keys, series_window


def pct_change(col: str, keys, periods: int = 12, period_col: str = PERIOD) -> Column:
    """``(v_t / v_{t-periods} - 1) * 100``; NULL for the first ``periods`` rows.

    Division by a zero base gives NULL (missing) instead of +/-inf.
    """
    w = series_window(keys, period_col)
    prev = F.lag(F.col(col), periods).over(w)
    return (F.try_divide(F.col(col), prev) - F.lit(1.0)) * F.lit(100.0)


def add_pct_change(df: DataFrame, keys, col: str, out: str, periods: int = 12,
                   period_col: str = PERIOD) -> DataFrame:
    if col not in df.columns:
        raise KeyError(f"Column '{col}' not found in DataFrame.")
    return df.withColumn(out, pct_change(col, keys, periods, period_col))


def lag_columns(df: DataFrame, keys, cols: Sequence[str], max_lag: int,
                period_col: str = PERIOD) -> dict[str, Column]:
    """``{c}_lag_{k}`` for k = 1..max_lag; unknown columns are skipped."""
    w = series_window(keys, period_col)
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        for k in range(1, max_lag + 1):
            out[f"{c}_lag_{k}"] = F.lag(F.col(c), k).over(w)
    return out


def add_lags(df: DataFrame, keys, cols: Sequence[str], max_lag: int,
             period_col: str = PERIOD) -> DataFrame:
    if not 1 <= max_lag <= 24:
        raise ValueError("max_lag must be in [1, 24]")
    return df.withColumns(lag_columns(df, keys, cols, max_lag, period_col))


def rolling_columns(df: DataFrame, keys, cols: Sequence[str], windows: Sequence[int],
                    period_col: str = PERIOD) -> dict[str, Column]:
    """Mean and sample std of rows t-w..t-1 (min_periods=1; std needs 2)."""
    base = series_window(keys, period_col)
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        for w in windows:
            frame = base.rowsBetween(-int(w), -1)
            out[f"{c}_roll_mean_{w}"] = F.avg(F.col(c)).over(frame)
            out[f"{c}_roll_std_{w}"] = F.stddev_samp(F.col(c)).over(frame)
    return out


def add_rolling(df: DataFrame, keys, cols: Sequence[str], windows: Sequence[int],
                period_col: str = PERIOD) -> DataFrame:
    return df.withColumns(rolling_columns(df, keys, cols, windows, period_col))


def diff_columns(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> dict[str, Column]:
    w = series_window(keys, period_col)
    return {f"{c}_diff1": F.col(c) - F.lag(F.col(c), 1).over(w) for c in cols if c in df.columns}


def add_diff(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    return df.withColumns(diff_columns(df, keys, cols, period_col))


def build_features(df: DataFrame, keys, level_col: str, target: str,
                   exog: Sequence[str] = (), aliases: dict[str, str] | None = None,
                   max_lag: int = 6, windows: Sequence[int] = (3, 6, 12),
                   use_differencing: bool = False, change_periods: int = 12,
                   period_col: str = PERIOD) -> DataFrame:
    """Full feature matrix: change target, aliases, lags, rolling, diffs.

    Rows are kept only where the target, every exogenous column and
    ``{target}_lag_1`` are present (the reference's required subset).
    Two window layers over one partitioning: the target first, then
    everything that reads it.
    """
    k = _keys(keys)
    out = add_pct_change(df, k, level_col, target, change_periods, period_col)
    if aliases:
        out = out.withColumns({new: F.col(old) for old, new in aliases.items()})
    feat_cols = [target] + [c for c in exog]
    cols = {}
    cols.update(lag_columns(out, k, feat_cols, max_lag, period_col))
    cols.update(rolling_columns(out, k, feat_cols, windows, period_col))
    if use_differencing:
        cols.update(diff_columns(out, k, [c for c in exog] + [target], period_col))
    out = out.withColumns(cols)
    required = [target] + list(exog) + [f"{target}_lag_1"]
    return out.na.drop(subset=required)
