"""The flagship query used by ``entry``: SURVEY §7.2 minimum slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators.features import add_lags, add_pct_change, add_rolling
from panelcast.plans import panels as P


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = P.PANEL_KEYS["A"]
    a = P.panel_a(spark, sf_dir)
    f = add_pct_change(a, keys, "v", "v_yoy", 12)
    f = add_lags(f, keys, ["v_yoy", "v"], 3)
    f = add_rolling(f, keys, ["v_yoy"], [3])
    return f.na.drop(subset=["v_yoy"])
