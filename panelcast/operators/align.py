"""Alignment of several series on their period (full outer semantics)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.calendar import PERIOD, _keys


def pivot_align(long_df: DataFrame, keys, series_col: str, period_col: str, value_col: str,
                series_ids: Sequence[str]) -> DataFrame:
    """Long ``(keys, series, period, value)`` -> wide ``(keys, period, s1, s2, ...)``.

    One ``groupBy`` (partial + final aggregate) with an explicit pivot list,
    so Spark does not run an extra job to discover the values. A period
    present in any series gets a row; absent series are NULL, which is the
    full outer join of the series on the period.
    """
    k = _keys(keys)
    return (long_df.groupBy(*k, period_col)
                   .pivot(series_col, list(series_ids))
                   .agg(F.first(value_col, ignorenulls=True)))


def outer_align(frames: Sequence[DataFrame], keys, period_col: str = PERIOD) -> DataFrame:
    """Chain of full outer equi-joins on ``keys + [period]``."""
    on = _keys(keys) + [period_col]
    return reduce(lambda a, b: a.join(b, on=on, how="full"), frames)
