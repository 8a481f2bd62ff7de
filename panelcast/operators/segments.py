"""Windows over very long series: several tasks for one key.

``Window.partitionBy(keys)`` sorts a whole series in one task; with ``keys=[]`` that is the
whole table. Here time is cut into segments of ``size`` periods, counted from a fixed
origin, so a row's segment follows from its own period and no global sort is needed:

* bounded look-back (lags, rolling windows, changes): a segment also gets the last
  ``before`` periods of the time before it (halo rows), the plain operator runs on
  ``keys + segment``, and the halo rows are dropped. On a regular calendar the rows are the same.
* unbounded look-back and look-ahead (fills, interpolation, the next present period): each
  segment is reduced to its first and last present point; a window over those
  few rows, one a segment, carries the points across segments.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import add_periods, elapsed_seconds, step_interval
from panelcast.operators.calendar import PERIOD, _keys
from panelcast.operators.features import build_features

SEGMENT, OWN = "_segment", "_own"


def period_index(period: str | Column, freq: str) -> Column:
    """Periods since 1970."""
    p = F.col(period) if isinstance(period, str) else period
    if freq == "month":
        return (F.year(p) - 1970) * 12 + F.month(p) - 1
    if freq == "day":
        return F.datediff(p, F.lit("1970-01-01").cast("date"))
    if freq == "hour":
        return F.datediff(p.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(p)
    raise ValueError(f"unknown freq {freq!r}")


def with_halo(df: DataFrame, freq: str, size: int, before: int, period_col: str = PERIOD) -> DataFrame:
    """Rows with ``_segment``; those of the last ``before`` periods before a segment come again as its halo (``_own`` false)."""
    at = period_index(period_col, freq)
    segments = F.sequence(F.floor(at / size), F.floor((at + before) / size))
    return (df.withColumn(SEGMENT, F.explode(segments))
            .withColumn(OWN, F.col(SEGMENT) == F.floor(period_index(period_col, freq) / size)))


def segmented(df: DataFrame, keys, op: Callable[[DataFrame, list[str]], DataFrame], freq: str, size: int, before: int,
              period_col: str = PERIOD) -> DataFrame:
    """``op(rows, keys)`` with windows that look back at most ``before`` periods, run per segment."""
    out = op(with_halo(df, freq, size, before, period_col), [*_keys(keys), SEGMENT])
    return out.filter(OWN).drop(SEGMENT, OWN)


def segmented_features(df: DataFrame, keys, level_col: str, target: str, exog: Sequence[str] = (), max_lag: int = 6,
                       windows: Sequence[int] = (3, 6, 12), use_differencing: bool = False, change_periods: int = 12,
                       freq: str = "month", size: int = 4096, period_col: str = PERIOD) -> DataFrame:
    """``build_features`` of a regular panel, segment by segment."""
    before = change_periods + max([max_lag, 1, *windows])
    return segmented(df, keys, lambda d, k: build_features(d, k, level_col, target, exog, None, max_lag, windows, use_differencing,
                                                           change_periods, period_col), freq, size, before, period_col)


def neighbours(df: DataFrame, keys, cols: Sequence[str], freq: str, size: int, period_col: str = PERIOD) -> DataFrame:
    """Adds ``_prev_<c>`` and ``_next_<c>``: the nearest present point (``v, t``) at or before, at or after each row."""
    k = [*_keys(keys), SEGMENT]
    rows = df.withColumn(SEGMENT, F.floor(period_index(period_col, freq) / size))
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(period_col).alias("t"))) for c in cols}
    inside = Window.partitionBy(*k).orderBy(period_col)
    rows = rows.withColumns({
        **{f"_prev_{c}": F.last(point[c], ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for c in cols},
        **{f"_next_{c}": F.first(point[c], ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing)) for c in cols}})
    ends = df.withColumn(SEGMENT, F.floor(period_index(period_col, freq) / size)).groupBy(*k).agg(
        *[F.max_by(point[c], F.when(F.col(c).isNotNull(), F.col(period_col))).alias(f"_last_{c}") for c in cols],
        *[F.min_by(point[c], F.when(F.col(c).isNotNull(), F.col(period_col))).alias(f"_first_{c}") for c in cols])
    over = Window.partitionBy(*_keys(keys)).orderBy(SEGMENT)  # one row a segment
    carried = ends.select(*k, *[x for c in cols for x in (
        F.last(f"_last_{c}", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_before_{c}"),
        F.first(f"_first_{c}", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias(f"_after_{c}"))])
    out = rows.join(carried, on=k, how="left")
    out = out.withColumns({**{f"_prev_{c}": F.coalesce(f"_prev_{c}", f"_before_{c}") for c in cols},
                           **{f"_next_{c}": F.coalesce(f"_next_{c}", f"_after_{c}") for c in cols}})
    return out.drop(SEGMENT, *[f"_{x}_{c}" for c in cols for x in ("before", "after")])


def segmented_spine(df: DataFrame, keys, freq: str = "month", size: int = 4096, period_col: str = PERIOD) -> DataFrame:
    """``fill_spine`` segment by segment: the next present period comes from the segment or is carried over;
    gaps are cut at segment ends before they are filled, so a gap of any length is dealt over tasks."""
    k = _keys(keys)
    others = [c for c in df.columns if c not in k and c != period_col]
    rows = df.withColumn(SEGMENT, F.floor(period_index(period_col, freq) / size))
    nxt = F.lead(period_col).over(Window.partitionBy(*k, SEGMENT).orderBy(period_col))
    firsts = rows.groupBy(*k, SEGMENT).agg(F.min(period_col).alias("_first"))
    carried = firsts.select(*k, SEGMENT, F.lead("_first").over(Window.partitionBy(*k).orderBy(SEGMENT)).alias("_carried"))
    rows = rows.withColumn("_lead", nxt).join(carried, on=[*k, SEGMENT], how="left")
    stop = F.coalesce(add_periods(F.coalesce("_lead", "_carried"), -1, freq), F.col(period_col))
    rows = rows.withColumn("_stop", stop)
    gap = F.col("_stop") > F.col(period_col)
    piece = F.explode(F.sequence(F.floor(period_index(period_col, freq) / size), F.floor(period_index("_stop", freq) / size)))
    gaps = rows.filter(gap).select(*k, period_col, "_stop", piece.alias("_piece"))
    at = period_index(period_col, freq)
    start = F.greatest(add_periods(period_col, 1, freq), add_periods(F.col(period_col), (F.col("_piece") * size - at).cast("int"), freq))
    end = F.least(F.col("_stop"), add_periods(F.col(period_col), ((F.col("_piece") + 1) * size - 1 - at).cast("int"), freq))
    filled = (gaps.withColumn("_from", start).withColumn("_to", end).filter("_from <= _to").repartition(*k, "_piece")
              .select(*k, F.explode(F.sequence("_from", "_to", step_interval(freq))).alias(period_col),
                      *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in others]))
    return df.select(*k, period_col, *others).unionByName(filled)


def segmented_impute(df: DataFrame, keys, value_cols: Sequence[str], threshold_pct: float = 5.0, freq: str = "month", size: int = 4096,
                     period_col: str = PERIOD, drop_all_missing: bool = True) -> DataFrame:
    """``impute`` segment by segment: the missing share of a series is an aggregate, the neighbours are carried."""
    k = _keys(keys)
    columns = df.columns
    rows = df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in value_cols})
    share = rows.withColumn("_all", F.lit(0)).groupBy("_all", *k).agg(
        *[F.round(F.avg(F.col(c).isNull().cast("double")) * 100.0, 2).alias(f"_pct_{c}") for c in value_cols])
    out = neighbours(rows, k, value_cols, freq, size, period_col).withColumn("_all", F.lit(0)).join(share, on=["_all", *k], how="left")

    def policy(c: str) -> Column:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        between = prev["v"] + (nxt["v"] - prev["v"]) * (elapsed_seconds(prev["t"], F.col(period_col)) / elapsed_seconds(prev["t"], nxt["t"]))
        filled = F.coalesce(prev["v"], nxt["v"])
        inner = F.when(nxt.isNotNull() & prev.isNotNull(), between).otherwise(filled)
        return F.when(F.col(c).isNotNull(), F.col(c)).when(F.col(f"_pct_{c}") > threshold_pct, inner).otherwise(filled)

    out = out.withColumns({c: policy(c) for c in value_cols}).select(*columns)
    return out.na.drop(how="all", subset=list(value_cols)) if drop_all_missing else out
