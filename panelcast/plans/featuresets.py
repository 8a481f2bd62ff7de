"""Standard feature tables used by the model queries, in Spark and in SQL.

Panel D is shaped like the reference's data (a level and two rates): the
target is the 12-month % change of ``level``; the OLS regressors mirror
``target ~ rate1 + rate2 + target_lag_1 + target_lag_3``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators.arma import lag_bound
from panelcast.operators.features import build_features
from panelcast.plans import panels as P

KD = P.PANEL_KEYS["D"]
FEAT_D = dict(level_col="level", target="level_yoy", exog=["rate1", "rate2"], max_lag=6, windows=[3, 6, 12],
              use_differencing=False)
TARGET_D = "level_yoy"
# The tables cover at most 83 months, so a series has at most 70 rows with a change and its lag: the
# ADF bound of the longest series, as a number for the SQL twins.
ADF_LAGS = lag_bound(70)
OLS_XS = ["rate1", "rate2", "level_yoy_lag_1", "level_yoy_lag_3"]


def feature_columns_d() -> list[str]:
    t, ex = FEAT_D["target"], FEAT_D["exog"]
    cols = list(ex)
    for c in [t] + ex:
        cols += [f"{c}_lag_{k}" for k in range(1, FEAT_D["max_lag"] + 1)]
    for c in [t] + ex:
        for w in FEAT_D["windows"]:
            cols += [f"{c}_roll_mean_{w}", f"{c}_roll_std_{w}"]
    return ["level"] + cols


def features_d(spark: SparkSession, sf: str) -> DataFrame:
    return build_features(P.panel_d(spark, sf), KD, **FEAT_D)


def sql_features(src: str, keys, level_col: str, target: str, exog=(), max_lag: int = 6, windows=(3, 6, 12),
                 change_periods: int = 12) -> str:
    """``build_features`` (without differencing) as DuckDB SQL over ``src``."""
    ex = list(exog)

    def w(frame: str = "") -> str:
        return f"PARTITION BY {', '.join(keys)} ORDER BY period {frame}".strip()
    body = []
    for c in [target] + ex:
        for k in range(1, max_lag + 1):
            body.append(f"lag({c}, {k}) OVER ({w()}) AS {c}_lag_{k}")
    for c in [target] + ex:
        for n in windows:
            fr = f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
            body.append(f"avg({c}) OVER ({w(fr)}) AS {c}_roll_mean_{n}")
            body.append(f"stddev_samp({c}) OVER ({w(fr)}) AS {c}_roll_std_{n}")
    req = " AND ".join(f"{c} IS NOT NULL" for c in [target] + ex + [f"{target}_lag_1"])
    chg = f"(({level_col} / nullif(lag({level_col}, {change_periods}) OVER ({w()}), 0)) - 1.0) * 100.0"
    return f"""SELECT * FROM (
SELECT *, {', '.join(body)} FROM (
SELECT *, {chg} AS {target} FROM ({src}) d0) d1) d2
WHERE {req}"""


def feature_columns(level_col: str, target: str, exog=(), max_lag: int = 6, windows=(3, 6, 12)) -> list[str]:
    ex = list(exog)
    cols = list(ex)
    for c in [target] + ex:
        cols += [f"{c}_lag_{k}" for k in range(1, max_lag + 1)]
    for c in [target] + ex:
        for n in windows:
            cols += [f"{c}_roll_mean_{n}", f"{c}_roll_std_{n}"]
    return [level_col] + cols


def sql_features_d() -> str:
    return sql_features(P.SQL_D, KD, "level", FEAT_D["target"], FEAT_D["exog"], FEAT_D["max_lag"], FEAT_D["windows"])
