"""Remaining projection / join / inference queries of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.calendar import infer_step
from panelcast.operators.models import OlsModel, align_target, complete_rows, numeric_columns
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.featuresets import KD, OLS_XS, TARGET_D, feature_columns_d, features_d, sql_features_d
from panelcast.plans.sqlbits import rnd
from panelcast.sources.io import coerce_numeric
from panelcast.sources.tables import read_table

KEYS_SQL = ", ".join(KD)
DP = 6


@register("coerce_numeric", ids=("P1",), sql="""
SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k_value,
       TRY_CAST(event_type AS DOUBLE) AS type_as_number
FROM events
""")
def q_coerce(spark, sf):
    e = read_table(spark, sf, "events").select(
        "event_id", F.regexp_extract("props", "([0-9]+)", 1).alias("k_value"), F.col("event_type").alias("type_as_number"))
    return coerce_numeric(e, ["k_value", "type_as_number"])


@register("numeric_projection", ids=("P4", "P5", "X2"), sql=f"""
SELECT period, {', '.join(f'round({c}, {DP}) AS {c}' for c in ['level', 'rate1', 'rate2'])}
FROM ({P.SQL_D}) d
""")
def q_numeric_projection(spark, sf):
    d = P.panel_d(spark, sf)
    cols = numeric_columns(d, exclude=KD)
    return d.select("period", *[rnd(c, DP).alias(c) for c in cols])


_FC = feature_columns_d()


@register("complete_rows", ids=("P8", "Q12"), sql=f"""
SELECT {KEYS_SQL}, count(*) AS n_complete, min(period) AS first_complete
FROM ({sql_features_d()}) f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FC)}
GROUP BY {KEYS_SQL}
""")
def q_complete_rows(spark, sf):
    c = complete_rows(features_d(spark, sf), _FC)
    return c.groupBy(*KD).agg(F.count(F.lit(1)).alias("n_complete"), F.min("period").alias("first_complete"))


@register("target_alignment", ids=("J3", "J2", "U1"), sql=f"""
SELECT {KEYS_SQL}, period, round({TARGET_D}, {DP}) AS y
FROM (SELECT {KEYS_SQL}, period, ((level / nullif(lag(level, 12) OVER (PARTITION BY {KEYS_SQL} ORDER BY period), 0)) - 1.0) * 100.0 AS {TARGET_D}
      FROM ({P.SQL_D}) d) t
WHERE {TARGET_D} IS NOT NULL
  AND ({KEYS_SQL}, period) IN (SELECT ({KEYS_SQL}, period) FROM ({sql_features_d()}) f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FC)})
""")
def q_target_alignment(spark, sf):
    from panelcast.operators.features import add_pct_change
    y = add_pct_change(P.panel_d(spark, sf), KD, "level", TARGET_D, 12).filter(F.col(TARGET_D).isNotNull())
    x = complete_rows(features_d(spark, sf), _FC)
    return align_target(x, y, KD).select(*KD, "period", rnd(TARGET_D, DP).alias("y"))


@register("target_on_raw", ids=("J4",), sql=f"""
SELECT d.{KD[0]}, d.{KD[1]}, d.period, round(d.level, {DP}) AS level, round(f.{TARGET_D}, {DP}) AS y
FROM ({P.SQL_D}) d LEFT JOIN ({sql_features_d()}) f USING ({KEYS_SQL}, period)
""")
def q_target_on_raw(spark, sf):
    d = P.panel_d(spark, sf)
    f = features_d(spark, sf).select(*KD, "period", TARGET_D)
    j = d.join(f, on=[*KD, "period"], how="left")
    return j.select(*KD, "period", rnd("level", DP).alias("level"), rnd(TARGET_D, DP).alias("y"))


@register("infer_frequency", ids=("A15",), sql="""
SELECT o_orderpriority AS series, mode(gap) AS step_days FROM (
  SELECT o_orderpriority, date_diff('day', lag(period) OVER (PARTITION BY o_orderpriority ORDER BY period), period) AS gap
  FROM (SELECT DISTINCT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders) a) g
WHERE gap IS NOT NULL GROUP BY 1
UNION ALL
SELECT event_type, mode(gap) FROM (
  SELECT event_type, date_diff('day', lag(period) OVER (PARTITION BY event_type ORDER BY period), period) AS gap
  FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS period FROM events) e) g
WHERE gap IS NOT NULL GROUP BY 1
""")
def q_infer_frequency(spark, sf):
    a = infer_step(P.panel_a(spark, sf), ["o_orderpriority"]).select(F.col("o_orderpriority").alias("series"), "step_days")
    e = infer_step(P.panel_e(spark, sf), ["event_type"]).select(F.col("event_type").alias("series"), "step_days")
    return a.unionByName(e)


def _pred_sql(dp: int = DP):
    from panelcast.functions.dual import SqlRel
    from panelcast.operators import ols
    fit = ols.fit(SqlRel(sql_features_d()), KD, TARGET_D, OLS_XS, hac_lags=6, complete_cols=_FC).sql
    coefs = ", ".join(["_obeta_const AS coef_const"] + [f"_obeta{j} AS coef_{x}" for j, x in enumerate(OLS_XS)])
    yhat = " + ".join(["coef_const"] + [f"coef_{x} * {x}" for x in OLS_XS])
    return f"""SELECT {KEYS_SQL}, period, round({yhat}, {dp}) AS y_pred
FROM ({sql_features_d()}) f JOIN (SELECT {KEYS_SQL}, {coefs} FROM ({fit}) z) c USING ({KEYS_SQL})"""


@register("ols_predict", ids=("E4", "X1", "F5"), sql=_pred_sql())
def q_ols_predict(spark, sf):
    m = OlsModel(KD, TARGET_D, OLS_XS, hac_lags=6, complete_cols=_FC)
    f = features_d(spark, sf)
    p = m.predict(f, m.fit(f))
    return p.select(*KD, "period", rnd("y_pred", DP).alias("y_pred"))


@register("ols_residuals", ids=("E5",), sql=f"""
SELECT {KEYS_SQL}, f.period, round(f.{TARGET_D} - p.y, {DP}) AS resid
FROM ({sql_features_d()}) f JOIN (SELECT {KEYS_SQL}, period, y_pred AS y FROM ({_pred_sql(12)}) q) p USING ({KEYS_SQL}, period)
WHERE p.y IS NOT NULL
""")
def q_ols_residuals(spark, sf):
    from panelcast.operators.report import residuals
    f = features_d(spark, sf)
    fit = OlsModel(KD, TARGET_D, OLS_XS, hac_lags=6, complete_cols=_FC).fit_table(f)
    return residuals(f, fit, KD, TARGET_D, OLS_XS).withColumn("resid", rnd("resid", DP))
