"""Stage 3 queries: change target, lags, rolling statistics, differences,
the full feature matrix. SQL twins are generated from the same parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.features import (
    add_diff,
    add_lags,
    add_pct_change,
    add_rolling,
    build_features,
)
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import MONEY_DP, RATIO_DP, rnd

KA = P.PANEL_KEYS["A"]
KD = P.PANEL_KEYS["D"]
# window means of cent amounts over 3 or 6 rows can end in an exact half
# cent; 4 dp avoids a rounding tie between the engines
MEAN_DP = 4


def _w(keys, frame: str = "") -> str:
    return f"PARTITION BY {', '.join(keys)} ORDER BY period {frame}".strip()


def sql_yoy(col: str, keys, periods: int = 12) -> str:
    return f"(({col} / nullif(lag({col}, {periods}) OVER ({_w(keys)}), 0)) - 1.0) * 100.0"


def sql_lag(col: str, keys, k: int) -> str:
    return f"lag({col}, {k}) OVER ({_w(keys)})"


def sql_roll(fn: str, col: str, keys, w: int) -> str:
    return f"{fn}({col}) OVER ({_w(keys, f'ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING')})"


@register("yoy", ids=("W1",), sql=f"""
SELECT o_orderpriority, period, round(v, {MONEY_DP}) AS v, round({sql_yoy('v', KA)}, {RATIO_DP}) AS v_yoy
FROM ({P.SQL_A}) a
""")
def q_yoy(spark, sf):
    a = add_pct_change(P.panel_a(spark, sf), KA, "v", "v_yoy", 12)
    return a.select(*KA, "period", rnd("v", MONEY_DP).alias("v"), rnd("v_yoy").alias("v_yoy"))


_LAG_SQL = ", ".join(f"round({sql_lag('v', KA, k)}, {MONEY_DP}) AS v_lag_{k}" for k in (1, 2, 3))


@register("lags", ids=("W2",), sql=f"""
SELECT o_orderpriority, period, {_LAG_SQL} FROM ({P.SQL_A}) a
""")
def q_lags(spark, sf):
    a = add_lags(P.panel_a(spark, sf), KA, ["v"], 3)
    return a.select(*KA, "period", *[rnd(f"v_lag_{k}", MONEY_DP).alias(f"v_lag_{k}") for k in (1, 2, 3)])


_ROLL_SQL = ", ".join(
    f"round({sql_roll('avg', 'v', KA, w)}, {MEAN_DP}) AS v_roll_mean_{w}, "
    f"round({sql_roll('stddev_samp', 'v', KA, w)}, {MONEY_DP}) AS v_roll_std_{w}" for w in (3, 6))


@register("rolling", ids=("W3", "W4"), sql=f"""
SELECT o_orderpriority, period, {_ROLL_SQL} FROM ({P.SQL_A}) a
""")
def q_rolling(spark, sf):
    a = add_rolling(P.panel_a(spark, sf), KA, ["v"], [3, 6])
    cols = [f"v_roll_{s}_{w}" for w in (3, 6) for s in ("mean", "std")]
    return a.select(*KA, "period", *[rnd(c, MEAN_DP if "mean" in c else MONEY_DP).alias(c) for c in cols])


@register("diff1", ids=("W5",), sql=f"""
SELECT o_orderpriority, period, round(v - {sql_lag('v', KA, 1)}, {MONEY_DP}) AS v_diff1,
       CAST(n - {sql_lag('n', KA, 1)} AS DOUBLE) AS n_diff1
FROM ({P.SQL_A}) a
""")
def q_diff1(spark, sf):
    a = add_diff(P.panel_a(spark, sf), KA, ["v", "n"])
    return a.select(*KA, "period", rnd("v_diff1", MONEY_DP).alias("v_diff1"),
                    F.col("n_diff1").cast("double").alias("n_diff1"))


# ---- the full feature matrix on panel D ----------------------------------
FM = dict(level_col="level", target="level_yoy", exog=["rate1", "rate2"],
          aliases={"rate1": "discount_pct", "rate2": "tax_pct"}, max_lag=3, windows=[3],
          use_differencing=True)


def _fm_columns():
    t, ex = FM["target"], FM["exog"]
    cols = [t] + ex
    out = []
    for c in cols:
        out += [f"{c}_lag_{k}" for k in range(1, FM["max_lag"] + 1)]
    for c in cols:
        for w in FM["windows"]:
            out += [f"{c}_roll_mean_{w}", f"{c}_roll_std_{w}"]
    out += [f"{c}_diff1" for c in ex + [t]]
    return out


def _fm_sql() -> str:
    t, ex = FM["target"], FM["exog"]
    inner = [f"{sql_yoy('level', KD)} AS {t}"]
    body = []
    for c in [t] + ex:
        for k in range(1, FM["max_lag"] + 1):
            body.append(f"{sql_lag(c, KD, k)} AS {c}_lag_{k}")
    for c in [t] + ex:
        for w in FM["windows"]:
            body.append(f"{sql_roll('avg', c, KD, w)} AS {c}_roll_mean_{w}")
            body.append(f"{sql_roll('stddev_samp', c, KD, w)} AS {c}_roll_std_{w}")
    for c in ex + [t]:
        body.append(f"{c} - {sql_lag(c, KD, 1)} AS {c}_diff1")
    outer = ", ".join(f"round({c}, {RATIO_DP}) AS {c}" for c in [t, "level", *ex] + _fm_columns())
    alias = ", ".join(f"round({o}, {RATIO_DP}) AS {n}" for o, n in FM["aliases"].items())
    req = " AND ".join(f"{c} IS NOT NULL" for c in [t] + ex + [f"{t}_lag_1"])
    return f"""
WITH d AS ({P.SQL_D}),
y AS (SELECT *, {', '.join(inner)} FROM d),
f AS (SELECT *, {', '.join(body)} FROM y)
SELECT l_returnflag, l_linestatus, period, {outer}, {alias}
FROM f WHERE {req}
"""


@register("feature_matrix", ids=("W1", "W2", "W3", "W4", "W5", "P3", "P7"), sql=_fm_sql())
def q_feature_matrix(spark, sf):
    d = P.panel_d(spark, sf)
    f = build_features(d, KD, **FM)
    cols = [FM["target"], "level", *FM["exog"]] + _fm_columns() + list(FM["aliases"].values())
    return f.select(*KD, "period", *[rnd(c).alias(c) for c in cols])


@register("daily_change", ids=("W1", "W2"), sql=f"""
SELECT event_type, period, round({sql_yoy('v', ['event_type'], 7)}, {RATIO_DP}) AS v_chg7,
       round({sql_lag('v', ['event_type'], 1)}, {MONEY_DP}) AS v_lag_1
FROM ({P.SQL_E}) e
""")
def q_daily_change(spark, sf):
    """Panel E (daily): 7-period change and a lag -- another frequency."""
    e = add_pct_change(P.panel_e(spark, sf), ["event_type"], "v", "v_chg7", 7)
    e = add_lags(e, ["event_type"], ["v"], 1)
    return e.select("event_type", "period", rnd("v_chg7").alias("v_chg7"), rnd("v_lag_1", MONEY_DP).alias("v_lag_1"))

