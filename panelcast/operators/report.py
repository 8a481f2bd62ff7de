"""Reporting as data: descriptive statistics, the per-series evidence row,
markdown tables and narrative text, chart data, JSON and text sinks.

Everything is one row (or a few rows) per series built with aggregates,
``map_from_entries`` and string functions; text is assembled in the JVM,
nothing goes through the driver.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.columns import fmt_fixed, significance_stars
from panelcast.operators.calendar import PERIOD, _keys
from panelcast.operators.evaluate import MODEL_PREFERENCE, preference_rank

# Report phrases whose wording carries meaning.
TREND_UP = "gradually increase"
TREND_DOWN = "gradually decline toward target"
TREND_FLAT = "remain relatively stable"
TREND_SHORT = "evolve as indicated"
TREND_BAND = 0.2
NO_METRICS = "_No model metrics available._"
EMPTY_ROW_5 = "| — | — | — | — | — |"
EMPTY_ROW_2 = "| — | — |"
MISSING = "N/A"
COMPARISON_HEADER = "| Model | MAE | RMSE | MAPE (%) |\n|-------|-----|------|----------|\n"


def describe(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    """Long ``(keys, column, n, mean, std, min, max, latest)``; std is ddof=1."""
    k = _keys(keys)
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                 F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                 F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(period_col))).alias(f"{c}__latest")]
    wide = df.groupBy(*k).agg(*aggs)
    stats = ("n", "mean", "std", "min", "max", "latest")
    entries = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").cast("bigint" if s == "n" else "double").alias(s)
                                                      for s in stats]) for c in cols]
    out = wide.select(*k, F.explode(F.array(*entries)).alias("_d"))
    return out.select(*k, *[F.col(f"_d.{x}").alias(x) for x in ("column",) + stats])


def span(df: DataFrame, keys, period_col: str = PERIOD) -> DataFrame:
    """``(keys, start_date, end_date, n_obs)`` with dates as yyyy-MM."""
    k = _keys(keys)
    return df.groupBy(*k).agg(F.date_format(F.min(period_col), "yyyy-MM").alias("start_date"),
                              F.date_format(F.max(period_col), "yyyy-MM").alias("end_date"),
                              F.count(F.lit(1)).cast("bigint").alias("n_obs"))


def trend_phrase(first: Column, last: Column, n: Column) -> Column:
    return (F.when(n < 2, F.lit(TREND_SHORT))
             .when(last > first + TREND_BAND, F.lit(TREND_UP))
             .when(last < first - TREND_BAND, F.lit(TREND_DOWN))
             .otherwise(F.lit(TREND_FLAT)))


def _ordered_lines(line: Column, order: Column) -> Column:
    """Lines of a group joined by newlines in ``order`` (one aggregate)."""
    arr = F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l"))))
    return F.concat_ws("\n", F.transform(arr, lambda s: s["l"]))


def comparison_table(summary: DataFrame, keys, model_col: str = "model") -> DataFrame:
    """Markdown table of mean MAE / RMSE / MAPE per model, per series."""
    k = _keys(keys)
    line = F.format_string("| %s | %s | %s | %s |", F.col(model_col), fmt_fixed("mae_mean", 4),
                           fmt_fixed("rmse_mean", 4), fmt_fixed("mape_mean", 2))
    order = F.struct(preference_rank(model_col, MODEL_PREFERENCE), F.col(model_col))
    header = COMPARISON_HEADER
    g = summary.groupBy(*k).agg(_ordered_lines(line, order).alias("_rows"), F.count(F.lit(1)).alias("_n"))
    return g.select(*k, F.when(F.col("_n") == 0, F.lit(NO_METRICS))
                         .otherwise(F.concat(F.lit(header), F.col("_rows"))).alias("comparison_md"))


def coefficient_lines(coefs: DataFrame, keys, term_order: Sequence[str]) -> DataFrame:
    """Econometric table rows: ``| term | coef.4f stars | se.4f | z.2f | p.4f |``."""
    k = _keys(keys)
    order = F.lit(len(term_order))
    for i in reversed(range(len(term_order))):
        order = F.when(F.col("term") == term_order[i], F.lit(i)).otherwise(order)
    line = F.format_string("| %s | %s%s | %s | %s | %s |", F.col("term"), fmt_fixed("coef", 4),
                           significance_stars("p_value"), fmt_fixed("std_err", 4), fmt_fixed("z_stat", 2),
                           fmt_fixed("p_value", 4))
    g = coefs.groupBy(*k).agg(_ordered_lines(line, order).alias("coeff_table"))
    return g.select(*k, F.coalesce(F.col("coeff_table"), F.lit(EMPTY_ROW_5)).alias("coeff_table"))


def forecast_table(fc: DataFrame, keys, value_col: str = "yhat", max_rows: int = 12, label: str = "yyyy-MM") -> DataFrame:
    """Forecast rows ``| yyyy-MM | v.2f |`` (first ``max_rows`` steps), the
    first forecast month and the trend phrase (last vs first forecast)."""
    k = _keys(keys)
    first = F.min_by(F.col(value_col), F.col("step"))
    last = F.max_by(F.col(value_col), F.col("step"))
    line = F.format_string("| %s | %s |", F.date_format(PERIOD, label), fmt_fixed(value_col, 2))
    shown = F.when(F.col("step") <= max_rows, line)
    g = fc.groupBy(*k).agg(_ordered_lines(shown, F.col("step")).alias("forecast_table"),
                           F.date_format(F.min(PERIOD), label).alias("forecast_start"),
                           trend_phrase(first, last, F.count(F.lit(1))).alias("trend_description"),
                           F.count(F.lit(1)).cast("bigint").alias("forecast_horizon"))
    return g


def interpretation(coefs: DataFrame, keys, *names: str) -> DataFrame:
    """One sign-based sentence per regressor (direction words fixed)."""
    k = _keys(keys)
    g = coefs.groupBy(*k).agg(*[F.coalesce(F.max(F.when(F.col("term") == x, F.col("coef"))), F.lit(0.0)).alias(f"_c{i}")
                                for i, x in enumerate(names)])
    lines = []
    for i, x in enumerate(names):
        down, tail = ("decrease", " (all else equal).") if i == 0 else ("decline", ".")
        lines.append(F.format_string(f"A one-unit increase in {x} is associated with a **%.4f** %s in the target{tail}",
                                     F.col(f"_c{i}"), F.when(F.col(f"_c{i}") < 0, down).otherwise("increase")))
    return g.select(*k, F.concat_ws(" ", *lines).alias("interpretation"))


def tail_rows(df: DataFrame, keys, n: int = 36, period_col: str = PERIOD) -> DataFrame:
    """The last ``n`` rows of each series (chart history)."""
    k = _keys(keys)
    w = (Window.partitionBy(*k) if k else Window.partitionBy()).orderBy(F.col(period_col).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def chart_data(history: DataFrame, fc: DataFrame, keys, y: str, tail: int = 36,
               reference_line: float | None = 2.0) -> DataFrame:
    """Long ``(keys, chart, series, x, y, lo, hi)`` for the forecast chart:
    last ``tail`` observations, the forecast with its band, and an optional
    constant reference line over the same dates."""
    k = _keys(keys)
    h = tail_rows(history.select(*k, PERIOD, y), k, tail)
    obs = h.select(*k, F.lit("forecast").alias("chart"), F.lit("history").alias("series"),
                   F.col(PERIOD).alias("x"), F.col(y).alias("y"), F.lit(None).cast("double").alias("lo"),
                   F.lit(None).cast("double").alias("hi"))
    lo = F.col("lo") if "lo" in fc.columns else F.lit(None).cast("double")
    hi = F.col("hi") if "hi" in fc.columns else F.lit(None).cast("double")
    f = fc.select(*k, F.lit("forecast").alias("chart"), F.lit("forecast").alias("series"),
                  F.col(PERIOD).alias("x"), F.col("yhat").alias("y"), lo.alias("lo"), hi.alias("hi"))
    out = obs.unionByName(f)
    if reference_line is not None:
        dates = out.select(*k, "x").distinct()
        ref = dates.select(*k, F.lit("forecast").alias("chart"), F.lit("reference").alias("series"), "x",
                           F.lit(float(reference_line)).alias("y"), F.lit(None).cast("double").alias("lo"),
                           F.lit(None).cast("double").alias("hi"))
        out = out.unionByName(ref)
    return out


def history_panels(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    """Long ``(keys, chart, series, x, y)``: the whole history of each column, one panel each."""
    k = _keys(keys)
    long = df.select(*k, period_col, *cols).unpivot([*k, period_col], list(cols), "series", "y")
    return long.select(*k, F.lit("history").alias("chart"), "series", F.col(period_col).alias("x"), "y")


def residuals(df: DataFrame, fitted: DataFrame, keys, y: str, xs: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    """``(keys, period, resid)``: observed less fitted, from a fit's coefficient columns."""
    k = _keys(keys)
    yhat = F.col("_obeta_const")
    for j, x in enumerate(xs):
        yhat = yhat + F.col(f"_obeta{j}") * F.col(x)
    coefs = fitted.select(*k, "_obeta_const", *[f"_obeta{j}" for j in range(len(xs))])
    return df.join(coefs, on=k).select(*k, period_col, (F.col(y) - yhat).alias("resid")).filter(F.col("resid").isNotNull())


def metric_bars(summary: DataFrame, keys) -> DataFrame:
    """``(keys, chart, series, model, value)`` for the model-comparison chart."""
    k = _keys(keys)
    cols = ["mae_mean", "rmse_mean", "mape_mean"]
    long = summary.select(*k, "model", *cols).unpivot(k + ["model"], cols, "metric", "value")
    return long.select(*k, F.lit("model_comparison").alias("chart"),
                       F.regexp_replace("metric", "_mean$", "").alias("series"), "model", "value")


def run_metadata(params: Mapping) -> dict:
    """Run id (8 hex of a UUID), UTC timestamp and config hash (first 8 hex
    of SHA-256 of the sorted-key JSON). Driver constants, added as literals."""
    blob = json.dumps(params, sort_keys=True, default=str)
    return {"run_id": uuid.uuid4().hex[:8],
            "timestamp": datetime.now(tz=timezone.utc).isoformat(),
            "config_hash": hashlib.sha256(blob.encode()).hexdigest()[:8]}


def nan_safe(col: Column) -> Column:
    """NaN -> NULL before JSON, so no bare NaN token is written."""
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def to_json_rows(df: DataFrame, keys) -> DataFrame:
    """``(keys, json)``: every column (NaN as null) serialised per row."""
    k = _keys(keys)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append((nan_safe(c) if isinstance(f.dataType, T.DoubleType) else c).alias(f.name))
    return df.select(*k, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink (one evidence object per series)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Evidence reader with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def write_markdown(df: DataFrame, keys, path: str, text_col: str = "markdown", mode: str = "overwrite") -> None:
    """Report texts as JSON lines with their keys: a bounded number of files whatever the number of series."""
    df.select(*_keys(keys), F.col(text_col).alias("markdown")).write.mode(mode).json(path)
