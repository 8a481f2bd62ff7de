"""Stage 2 queries: missingness, fills, interpolation, policy, validation.

Input is panel C with the calendar filled: 125 series, about a quarter of
the months empty, so both branches of the imputation policy are exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.quality import (
    bfill,
    ffill,
    impute,
    interp_time,
    missing_pct,
    validate,
)
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import MONEY_DP, rnd

KC = P.PANEL_KEYS["C"]
# interpolated midpoints of cent values end in a half cent; 4 dp keeps
# both engines away from a rounding tie
INTERP_DP = 4
W_SQL = "PARTITION BY n_name, o_orderpriority ORDER BY period"

def impute_sql(src: str, keys: list[str], col: str = "v", threshold: float = 5.0) -> str:
    """The imputation policy of ``operators.quality.impute`` as DuckDB SQL.

    Yields columns ``vi`` (interpolated), ``pct`` (missing %), ``v_out``.
    """
    w = f"PARTITION BY {', '.join(keys)} ORDER BY period"
    pre = f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    fol = f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""
WITH s AS ({src}),
x AS (
  SELECT *,
    last_value(CASE WHEN {col} IS NOT NULL THEN {col} END IGNORE NULLS) OVER ({w} {pre}) AS pv,
    last_value(CASE WHEN {col} IS NOT NULL THEN period END IGNORE NULLS) OVER ({w} {pre}) AS pt,
    first_value(CASE WHEN {col} IS NOT NULL THEN {col} END IGNORE NULLS) OVER ({w} {fol}) AS nv,
    first_value(CASE WHEN {col} IS NOT NULL THEN period END IGNORE NULLS) OVER ({w} {fol}) AS nt,
    round(avg(CASE WHEN {col} IS NULL THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY {', '.join(keys)}) * 100.0, 2) AS pct
  FROM s),
i AS (
  SELECT *, CASE WHEN {col} IS NOT NULL THEN {col}
                 WHEN nv IS NULL THEN pv
                 WHEN pv IS NOT NULL THEN pv + (nv - pv) * (CAST(date_diff('day', pt, period) AS DOUBLE) / CAST(date_diff('day', pt, nt) AS DOUBLE))
            END AS vi
  FROM x),
q AS (SELECT *, CASE WHEN pct > {threshold} THEN vi ELSE {col} END AS v0 FROM i),
r AS (SELECT *, last_value(v0 IGNORE NULLS) OVER ({w} {pre}) AS v1 FROM q),
t AS (SELECT *, first_value(v1 IGNORE NULLS) OVER ({w} {fol}) AS v2 FROM r),
u AS (SELECT *, CASE WHEN pct = 0 THEN {col} ELSE v2 END AS v_out FROM t)
"""


_INTERP_SQL = impute_sql(P.SQL_C_SPINE, KC)


@register("missing_pct", ids=("A2", "F6"), sql=f"""
SELECT n_name, o_orderpriority, 'v' AS "column",
       round(avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) * 100.0, 2) AS missing_pct
FROM ({P.SQL_C_SPINE}) s GROUP BY 1, 2
""")
def q_missing_pct(spark, sf):
    return missing_pct(P.panel_c(spark, sf, spine=True), KC, ["v"])


@register("ffill_bfill", ids=("P10", "P11"), sql=f"""
WITH s AS ({P.SQL_C_SPINE}),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vf FROM s)
SELECT n_name, o_orderpriority, period,
       round(vf, {MONEY_DP}) AS v_ffill,
       round(first_value(vf IGNORE NULLS) OVER ({W_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), {MONEY_DP}) AS v_filled
FROM f
""")
def q_ffill_bfill(spark, sf):
    c = P.panel_c(spark, sf, spine=True).withColumn("v_ffill", ffill("v", KC))
    c = c.withColumn("v_filled", bfill("v_ffill", KC))
    return c.select(*KC, "period", rnd("v_ffill", MONEY_DP).alias("v_ffill"), rnd("v_filled", MONEY_DP).alias("v_filled"))


@register("interp_time", ids=("P13",), sql=_INTERP_SQL + f"""
SELECT n_name, o_orderpriority, period, round(vi, {INTERP_DP}) AS v_interp FROM u
""")
def q_interp_time(spark, sf):
    c = P.panel_c(spark, sf, spine=True)
    return c.select(*KC, "period", rnd(interp_time("v", KC), INTERP_DP).alias("v_interp"))


@register("impute_policy", ids=("P14", "P10", "P11", "P13", "Q13"), sql=_INTERP_SQL + f"""
SELECT n_name, o_orderpriority, period, round(v_out, {INTERP_DP}) AS v FROM u WHERE v_out IS NOT NULL
""")
def q_impute_policy(spark, sf):
    c = impute(P.panel_c(spark, sf, spine=True), KC, ["v"], threshold_pct=5.0)
    return c.select(*KC, "period", rnd("v", INTERP_DP).alias("v"))


_B_MONTHS = """
  SELECT c.c_nationkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period, sum(o.o_totalprice) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2"""
_B_SPINE = f"""
SELECT g.c_nationkey, g.period, s.v FROM
 (SELECT c_nationkey, CAST(unnest(generate_series(CAST(min(period) AS TIMESTAMP), CAST(max(period) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period
  FROM ({_B_MONTHS}) s0 GROUP BY 1) g
LEFT JOIN ({_B_MONTHS}) s USING (c_nationkey, period)"""


@register("low_gap_fill", ids=("P14", "P10", "P11"), sql=impute_sql(_B_SPINE, ["c_nationkey"]) + f"""
SELECT c_nationkey, period, round(v_out, {INTERP_DP}) AS v, pct AS missing_pct FROM u
""")
def q_low_gap_fill(spark, sf):
    """Panel B with its calendar filled: a few nations miss a month, which
    takes the <=5 % branch (forward/backward fill)."""
    from panelcast.operators.calendar import fill_spine
    from panelcast.operators.quality import missing_pct_window
    b = P.panel_b(spark, sf)
    b = fill_spine(b, ["c_nationkey"])
    b = b.withColumn("missing_pct", missing_pct_window("v", ["c_nationkey"]))
    out = impute(b, ["c_nationkey"], ["v"], drop_all_missing=False)
    return out.select("c_nationkey", "period", rnd("v", INTERP_DP).alias("v"), "missing_pct")


@register("quality_report", ids=("A3", "U3"), sql="""
WITH d AS (SELECT l_returnflag, l_linestatus, sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS level,
                  avg(l_discount) * 100.0 AS rate1, avg(l_tax) * 100.0 AS rate2
           FROM lineitem GROUP BY l_returnflag, l_linestatus, date_trunc('month', l_shipdate)),
a AS (SELECT l_returnflag, l_linestatus,
             CAST(CASE WHEN count(*) < 36 THEN count(*) ELSE 0 END AS BIGINT) AS insufficient_data,
             CAST(count_if(level <= 0) AS BIGINT) AS level_non_positive,
             CAST(count_if(rate1 < 0 OR rate1 > 5) AS BIGINT) AS rate1_out_of_range,
             CAST(count_if(rate2 < 0) AS BIGINT) AS rate2_negative
      FROM d GROUP BY 1, 2),
u AS (UNPIVOT a ON insufficient_data, level_non_positive, rate1_out_of_range, rate2_negative
      INTO NAME "check" VALUE n_bad)
SELECT l_returnflag, l_linestatus, "check",
       CASE WHEN "check" IN ('insufficient_data', 'level_non_positive') THEN 'error' ELSE 'warning' END AS severity,
       n_bad
FROM u WHERE n_bad > 0
""")
def q_quality_report(spark, sf):
    d = P.panel_d(spark, sf)
    return validate(d, P.PANEL_KEYS["D"], required=["level", "rate1", "rate2"], min_obs=36,
                    positive=["level"], ranges={"rate1": (0.0, 5.0)}, nonnegative=["rate2"])


@register("fill_all_columns", ids=("P10", "P11", "P12"), sql=f"""
WITH s AS ({P.SQL_C_SPINE}),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vf FROM s)
SELECT n_name, o_orderpriority, period, round(coalesce(vf, 0.0), {MONEY_DP}) AS v_scoring
FROM f
""")
def q_fill_scoring(spark, sf):
    """Scoring-time fill: forward fill, then constant 0 for leading gaps."""
    c = P.panel_c(spark, sf, spine=True)
    return c.select(*KC, "period", rnd(F.coalesce(ffill("v", KC), F.lit(0.0)), MONEY_DP).alias("v_scoring"))

