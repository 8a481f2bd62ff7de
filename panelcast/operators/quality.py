"""Missing-data and quality operators.

Everything is a window over ``partitionBy(keys)`` -- the same partitioning
as the feature windows -- so the missing-rate, the fill and the
interpolation add sort/window work but no extra exchange, and no per-key
value goes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import elapsed_seconds
from panelcast.operators.calendar import PERIOD, _keys, series_window


class DataQualityError(ValueError):
    """Raised by the strict validation wrapper."""


def _missing(col: str) -> Column:
    c = F.col(col)
    return c.isNull() | F.isnan(c)


def missing_pct(df: DataFrame, keys, value_cols: Sequence[str]) -> DataFrame:
    """Long table ``(keys, column, missing_pct)``; percent rounded to 2 dp."""
    k = _keys(keys)
    aggs = [F.round(F.avg(_missing(c).cast("double")) * 100.0, 2).alias(c) for c in value_cols]
    wide = df.groupBy(*k).agg(*aggs)
    return wide.unpivot(k, list(value_cols), "column", "missing_pct") if k else \
        wide.unpivot([], list(value_cols), "column", "missing_pct")


def missing_pct_window(col: str, keys) -> Column:
    """Per-series missing % of ``col`` as a window value (2 dp)."""
    k = _keys(keys)
    w = Window.partitionBy(*k) if k else Window.partitionBy()
    return F.round(F.avg(_missing(col).cast("double")).over(w) * 100.0, 2)


def ffill(col: str, keys, period_col: str = PERIOD) -> Column:
    w = series_window(keys, period_col).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(F.col(col), ignorenulls=True).over(w)


def bfill(col: str, keys, period_col: str = PERIOD) -> Column:
    w = series_window(keys, period_col).rowsBetween(0, Window.unboundedFollowing)
    return F.first(F.col(col), ignorenulls=True).over(w)


def interp_time(col: str, keys, period_col: str = PERIOD) -> Column:
    """Time-weighted linear interpolation between the neighbouring present
    values; a trailing gap takes the last value, a leading gap stays NULL."""
    base = series_window(keys, period_col)
    present = F.col(col).isNotNull()
    point = F.when(present, F.struct(F.col(col).alias("v"), F.col(period_col).alias("t")))
    prev = F.last(point, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, 0))
    nxt = F.first(point, ignorenulls=True).over(base.rowsBetween(0, Window.unboundedFollowing))
    frac = elapsed_seconds(prev["t"], F.col(period_col)) / elapsed_seconds(prev["t"], nxt["t"])
    between = prev["v"] + (nxt["v"] - prev["v"]) * frac
    return (F.when(present, F.col(col))
             .when(nxt.isNull(), prev["v"])
             .when(prev.isNotNull(), between))


def impute(df: DataFrame, keys, value_cols: Sequence[str], threshold_pct: float = 5.0,
           period_col: str = PERIOD, drop_all_missing: bool = True) -> DataFrame:
    """Per (series, column) policy: 0 % missing -> unchanged; <= threshold ->
    forward then backward fill; above -> time interpolation, then the fills.

    The percentage is rounded to 2 dp before the comparison. NaN counts as
    missing and is turned into NULL first.
    """
    k = _keys(keys)
    out = df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in value_cols})
    out = out.withColumns({f"_pct_{c}": missing_pct_window(c, k) for c in value_cols})
    out = out.withColumns({f"_int_{c}": F.when(F.col(f"_pct_{c}") > threshold_pct, interp_time(c, k, period_col))
                                              .otherwise(F.col(c)) for c in value_cols})
    out = out.withColumns({f"_ff_{c}": ffill(f"_int_{c}", k, period_col) for c in value_cols})
    out = out.withColumns({f"_bf_{c}": bfill(f"_ff_{c}", k, period_col) for c in value_cols})
    out = out.withColumns({c: F.when(F.col(f"_pct_{c}") == 0, F.col(c)).otherwise(F.col(f"_bf_{c}"))
                           for c in value_cols})
    out = out.drop(*[f"_{p}_{c}" for p in ("pct", "int", "ff", "bf") for c in value_cols])
    if drop_all_missing:
        out = out.na.drop(how="all", subset=list(value_cols))
    return out


def check_schema(df: DataFrame, required: Sequence[str], period_col: str = PERIOD) -> None:
    """Raises one ``DataQualityError`` with everything wrong with the schema: missing columns, a period that
    is no date or time. Runs on the plan, before any column is selected."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    errors = []
    if kinds.get(period_col) not in ("date", "timestamp", "timestamp_ntz"):
        errors.append(f"Index '{period_col}' must be a date or time, found {kinds.get(period_col, 'no such column')}.")
    missing = [c for c in required if c not in kinds]
    if missing:
        errors.append(f"Missing required columns: {missing}")
    if errors:
        raise DataQualityError("Data quality validation failed:\n" + "\n".join(errors))


def gap_report(df: DataFrame, keys, freq: str = "month", max_gap: int = 1200, period_col: str = PERIOD) -> DataFrame:
    """``(keys, check, severity, n_bad)``: series with gaps of more than ``max_gap`` periods between two present
    ones, as one wrong timestamp makes; an error, found before anything is filled."""
    from panelcast.operators.segments import period_index

    k = _keys(keys)
    at = period_index(period_col, freq)
    gaps = df.select(*k, (at - F.lag(at).over(series_window(k, period_col)) - 1).alias("_gap"))
    return (gaps.groupBy(*k).agg(F.count_if(F.col("_gap") > max_gap).alias("n_bad")).filter("n_bad > 0")
            .select(*k, F.lit("gap_too_long").alias("check"), F.lit("error").alias("severity"), "n_bad"))


def validate(df: DataFrame, keys, required: Sequence[str] = (), min_obs: int = 36,
             positive: Sequence[str] = (), ranges: Mapping[str, tuple[float, float]] | None = None,
             nonnegative: Sequence[str] = ()) -> DataFrame:
    """Quality report ``(keys, check, severity, n_bad)``, one row per failed check.

    * missing required columns (checked on the schema, driver side);
    * fewer than ``min_obs`` rows in a series -> error;
    * non-positive values in ``positive`` columns -> error;
    * values outside ``ranges`` and negatives in ``nonnegative`` -> warning.
    One ``groupBy(keys)`` with ``count_if`` columns, then an unpivot.
    """
    k = _keys(keys)
    missing_cols = [c for c in required if c not in df.columns]
    if missing_cols:
        raise DataQualityError(f"Missing required columns: {missing_cols}")
    checks: list[tuple[str, str, Column]] = [
        ("insufficient_data", "error", F.when(F.count(F.lit(1)) < min_obs, F.count(F.lit(1))).otherwise(F.lit(0)))]
    for c in positive:
        checks.append((f"{c}_non_positive", "error", F.count_if(F.col(c) <= 0)))
    for c, (lo, hi) in (ranges or {}).items():
        checks.append((f"{c}_out_of_range", "warning", F.count_if((F.col(c) < lo) | (F.col(c) > hi))))
    for c in nonnegative:
        checks.append((f"{c}_negative", "warning", F.count_if(F.col(c) < 0)))
    agg = df.groupBy(*k).agg(*[x.cast("bigint").alias(name) for name, _, x in checks])
    sev = F.create_map(*[F.lit(v) for name, s, _ in checks for v in (name, s)])
    long = agg.unpivot(k, [name for name, _, _ in checks], "check", "n_bad")
    return (long.filter(F.col("n_bad") > 0)
                .withColumn("severity", sev[F.col("check")])
                .select(*k, "check", "severity", "n_bad"))


def validate_strict(report: DataFrame, shown: int = 20) -> None:
    """Raise ``DataQualityError`` if the report has error rows; the message
    gives their number and lists the first ``shown``."""
    errors = report.filter(F.col("severity") == "error")
    total = errors.count()
    if total:
        first = errors.sort(*errors.columns).limit(shown).collect()
        lines = [", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in first]
        raise DataQualityError(f"Data quality validation failed ({total} errors, {len(first)} listed):\n" + "\n".join(lines))
