"""Multi-step forecasts per series.

* ``future_calendar``: the next ``h`` periods after each series' last one.
* ``naive_forecast``: last observed value repeated (the fallback forecast).
* ``recursive_linear_forecast``: a linear model rolled forward ``h`` steps;
  after each step the target's own lag regressors are refreshed from a
  buffer (history + predictions) and every other regressor is held at its
  last observed value. One ``aggregate`` higher-order function per series
  row -- no Python, no loop over steps on the driver.

Inputs are one row per series (last row, coefficients); the history buffer
holds only the last ``max_lag`` target values, so nothing grows with the
length of a series.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import add_periods
from panelcast.operators.calendar import PERIOD, _keys


def last_rows(df: DataFrame, keys, cols: Sequence[str], period_col: str = PERIOD) -> DataFrame:
    """Last row of each series (max period): ``(keys, last_period, cols...)``."""
    k = _keys(keys)
    s = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(period_col))
    g = df.groupBy(*k).agg(F.max(period_col).alias("last_period"), s.alias("_last"))
    return g.select(*k, "last_period", *[F.col(f"_last.{c}").alias(c) for c in cols])


def last_values(df: DataFrame, keys, col: str, n: int, period_col: str = PERIOD,
                name: str = "history") -> DataFrame:
    """The last ``n`` values of ``col`` per series, oldest first, as an array.

    Rows are cut to the last ``n`` by a window rank before ``collect_list``,
    so the collected array is bounded by ``n``, not by the series length.
    """
    k = _keys(keys)
    w = (Window.partitionBy(*k) if k else Window.partitionBy()).orderBy(F.col(period_col).desc())
    tail = df.filter(F.col(col).isNotNull()).withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
    arr = F.transform(F.sort_array(F.collect_list(F.struct(F.col(period_col).alias("p"), F.col(col).alias("v")))),
                      lambda s: s["v"])
    return tail.groupBy(*k).agg(arr.alias(name))


def future_calendar(last: DataFrame, keys, h: int, freq: str = "month",
                    last_col: str = "last_period", carry: Sequence[str] = ()) -> DataFrame:
    """``(keys, step, period, carry...)`` for steps 1..h after ``last_col``."""
    k = _keys(keys)
    out = last.select(*k, last_col, *carry, F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step"))
    return out.select(*k, "step", add_periods(F.col(last_col), F.col("step"), freq).alias(PERIOD), *carry)


def naive_forecast(df: DataFrame, keys, y: str, h: int, freq: str = "month",
                   period_col: str = PERIOD) -> DataFrame:
    """Last non-missing value repeated over the next ``h`` periods."""
    k = _keys(keys)
    last = (df.filter(F.col(y).isNotNull()).groupBy(*k)
              .agg(F.max(period_col).alias("last_period"), F.max_by(F.col(y), F.col(period_col)).alias("yhat")))
    return future_calendar(last, k, h, freq, carry=["yhat"])


def lag_index(col: str, target: str) -> int | None:
    m = re.match(rf"^{re.escape(target)}_lag_(\d+)$", col)
    return int(m.group(1)) if m else None


def recursive_linear_forecast(state: DataFrame, keys, target: str, xs: Sequence[str],
                              coef_cols: Sequence[str], const_col: str, h: int,
                              freq: str = "month", history_col: str = "history",
                              advance_origin: bool = False) -> DataFrame:
    """Roll ``yhat = const + sum(beta_j * x_j)`` forward ``h`` steps.

    ``state`` has one row per series with the last observed regressors
    ``xs``, their coefficients ``coef_cols``, the intercept, ``last_period``
    and ``history`` (last values of the target, oldest first). Regressors
    named ``{target}_lag_{n}`` are refreshed from the buffer after each
    step; at step 1 the last row is used unchanged (the reference's
    behaviour) unless ``advance_origin``.
    """
    k = _keys(keys)
    lagged = {x: lag_index(x, target) for x in xs}

    def step_value(acc, i):
        buf = acc["buf"]
        total: Column = F.col(const_col)
        for x, b in zip(xs, coef_cols):
            n = lagged[x]
            if n is None:
                v = F.col(x)
            else:
                from_buf = F.element_at(buf, -n)
                v = from_buf if advance_origin else F.when(i == 1, F.col(x)).otherwise(from_buf)
            total = total + F.col(b) * v
        return F.struct(F.concat(buf, F.array(total)).alias("buf"),
                        F.concat(acc["out"], F.array(total)).alias("out"))

    init = F.struct(F.col(history_col).cast("array<double>").alias("buf"),
                    F.array().cast("array<double>").alias("out"))
    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(int(h))), init, step_value)
    out = state.select(*k, "last_period", rolled["out"].alias("_out"))
    out = out.select(*k, "last_period", F.posexplode("_out").alias("_i", "yhat"))
    return out.select(*k, (F.col("_i") + 1).alias("step"),
                      add_periods(F.col("last_period"), F.col("_i") + 1, freq).alias(PERIOD), "yhat")


def recursive_model_forecast(state: DataFrame, keys, target: str, feature_cols: Sequence[str], model,
                             h: int, freq: str = "month", history_col: str = "history",
                             checkpoint_every: int = 4) -> DataFrame:
    """Roll a fitted Spark ML regressor forward ``h`` steps per series.

    ``state``: one row per series with the last feature values, ``history``
    (last target values, oldest first) and ``last_period``. Each step
    assembles the features, predicts, appends the prediction to the buffer
    and refreshes the ``{target}_lag_{n}`` features from it; other features
    are held at their last values. Step 1 uses the last row unchanged. The
    loop runs on the small per-series table; every ``checkpoint_every``
    steps its lineage is cut with a reliable ``checkpoint()`` (written to
    ``spark.checkpoint.dir``) so a lost executor does not replay all steps.
    """
    from pyspark.ml.feature import VectorAssembler
    k = _keys(keys)
    lagged = {c: lag_index(c, target) for c in feature_cols}
    va = VectorAssembler(inputCols=list(feature_cols), outputCol="_features", handleInvalid="keep")
    cur = state.withColumn("_buf", F.col(history_col).cast("array<double>")) \
               .withColumn("_out", F.array().cast("array<double>"))
    for step in range(1, int(h) + 1):
        pred = model.transform(va.transform(cur).withColumnRenamed("_features", model.getFeaturesCol()))
        pred = pred.drop(model.getFeaturesCol())
        cur = pred.withColumns({"_buf": F.concat("_buf", F.array(F.col(model.getPredictionCol()))),
                                "_out": F.concat("_out", F.array(F.col(model.getPredictionCol())))})
        cur = cur.drop(model.getPredictionCol())
        cur = cur.withColumns({c: F.element_at("_buf", -n) for c, n in lagged.items() if n is not None})
        if checkpoint_every and step % checkpoint_every == 0 and step < h:
            cur = cur.checkpoint(eager=True)
    out = cur.select(*k, "last_period", F.posexplode("_out").alias("_i", "yhat"))
    return out.select(*k, (F.col("_i") + 1).alias("step"),
                      add_periods(F.col("last_period"), F.col("_i") + 1, freq).alias(PERIOD), "yhat")
