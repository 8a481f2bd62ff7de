"""Calendar operators: resample to a regular period grid, fill the grid,
filter by date range.

Scale notes
-----------
* ``resample_*`` is one ``groupBy(keys, period)``: Spark runs a partial
  (map-side) aggregate before the shuffle, so a hot key that holds a third
  of the raw rows is collapsed to one row per (key, period) per task before
  anything moves. After it, a series has at most #periods rows.
* ``fill_spine`` adds the empty periods without a join: one window on
  ``keys`` finds the next present period and an ``explode(sequence(...))``
  emits the gap rows in place, so the hash partitioning on ``keys`` is kept
  for every later window operator (no second exchange).
* ``date_range_filter_raw`` puts the period bounds on the *raw* time column
  as literals, so the predicate reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import add_periods, period_bounds, period_of, step_interval

PERIOD = "period"


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def series_window(keys, order: str = PERIOD) -> Window:
    """``Window.partitionBy(keys).orderBy(order)``; one shared spec keeps one exchange."""
    k = _keys(keys)
    w = Window.partitionBy(*k) if k else Window.partitionBy()
    return w.orderBy(order)


def date_range_filter_raw(df: DataFrame, time_col: str, start=None, end=None,
                          freq: str = "month") -> DataFrame:
    """Keep raw rows whose period falls in ``[start, end]`` (inclusive).

    The predicate is ``time_col >= lo AND time_col < hi`` on the raw column
    with literal bounds (pushed to Parquet), not on ``trunc(time_col)``.
    """
    lo, hi = period_bounds(start, end, freq)
    lit = _time_literal(df, time_col)
    cond = None
    if lo is not None:
        cond = F.col(time_col) >= lit(lo)
    if hi is not None:
        c2 = F.col(time_col) < lit(hi)
        cond = c2 if cond is None else cond & c2
    return df if cond is None else df.filter(cond)


def _time_literal(df: DataFrame, time_col: str):
    """Literal builder in the column's own type, parsed from text.

    A Python ``datetime`` literal is a session-zone TIMESTAMP; against a
    TIMESTAMP_NTZ column that comparison would move with the session time
    zone. Parsing the wall-clock text into the column's type is zone-free and
    still constant-folds into a literal that reaches the Parquet scan.
    """
    dtype = df.schema[time_col].dataType.typeName()
    def lit(x):
        txt = F.lit(x.strftime("%Y-%m-%d %H:%M:%S"))
        if dtype == "timestamp_ntz":
            return F.to_timestamp_ntz(txt)
        if dtype == "date":
            return F.to_date(txt)
        return F.to_timestamp(txt)
    return lit


def date_range_filter(df: DataFrame, start=None, end=None, period_col: str = PERIOD) -> DataFrame:
    """Inclusive filter on an already-resampled period column."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(period_col) >= F.to_date(F.lit(str(start))))
    if end is not None:
        cond = cond & (F.col(period_col) <= F.to_date(F.lit(str(end))))
    return df.filter(cond)


def resample_agg(df: DataFrame, keys, time_col: str, aggs: Mapping[str, Column],
                 freq: str = "month") -> DataFrame:
    """``groupBy(keys, period).agg(**aggs)`` with period = start of the period."""
    k = _keys(keys)
    return (df.groupBy(*k, period_of(time_col, freq).alias(PERIOD))
              .agg(*[c.alias(n) for n, c in aggs.items()]))


def resample_last(df: DataFrame, keys, time_col: str, value_cols: Sequence[str],
                  freq: str = "month", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Last non-missing value of each column per (key, period).

    "Last" is by the raw time, then by ``tiebreak`` columns, so the result
    does not depend on input row order. ``max_by`` skips rows whose ordering
    is NULL, which is how missing values are excluded per column.
    """
    order_cols = [F.col(time_col)] + [F.col(t) for t in tiebreak]
    aggs = {}
    for v in value_cols:
        ok = F.col(v).isNotNull() & ~F.isnan(F.col(v))
        aggs[v] = F.max_by(F.col(v), F.when(ok, F.struct(*order_cols)))
    return resample_agg(df, keys, time_col, aggs, freq)


def fill_spine(df: DataFrame, keys, freq: str = "month", period_col: str = PERIOD,
               end=None) -> DataFrame:
    """Insert the missing periods of every series (values NULL).

    Per series the grid runs from its first to its last present period
    (``end`` extends it to a fixed last period). Other columns of the gap
    rows are NULL; key columns are kept.
    """
    k = _keys(keys)
    w = series_window(k, period_col)
    nxt = F.lead(period_col).over(w)
    stop = add_periods(nxt, -1, freq)
    if end is not None:
        end_lit = F.to_date(F.lit(str(end))) if freq != "hour" else F.lit(str(end)).cast("timestamp_ntz")
        stop = F.coalesce(stop, F.greatest(F.col(period_col), end_lit))
    stop = F.coalesce(stop, F.col(period_col))
    others = [c for c in df.columns if c not in k and c != period_col]
    g = (df.withColumn("_pc_stop", stop)
           .withColumn("_pc_p", F.explode(F.sequence(F.col(period_col), F.col("_pc_stop"), step_interval(freq)))))
    present = F.col("_pc_p") == F.col(period_col)
    out = [F.col(c) for c in k] + [F.col("_pc_p").alias(period_col)]
    out += [F.when(present, F.col(c)).alias(c) for c in others]
    return g.select(*out)


def infer_step(df: DataFrame, keys, period_col: str = PERIOD) -> DataFrame:
    """Most common gap between consecutive periods per series (in days).

    Used only to report whether the input was already regular.
    """
    k = _keys(keys)
    w = series_window(k, period_col)
    gaps = df.select(*k, F.datediff(F.col(period_col), F.lag(period_col).over(w)).alias("gap_days"))
    return gaps.filter(F.col("gap_days").isNotNull()).groupBy(*k).agg(F.mode("gap_days").alias("step_days"))
