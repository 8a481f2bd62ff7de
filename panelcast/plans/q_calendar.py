"""Stage 1 queries: scan, resample, spine, date filter, alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.calendar import date_range_filter, date_range_filter_raw, resample_last
from panelcast.operators.align import outer_align, pivot_align
from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import MONEY_DP, RATIO_DP, rnd
from panelcast.sources.tables import read_table

PRIORITY_COLS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
                 "4-NOT SPECIFIED": "not_specified", "5-LOW": "low"}


@register("panel_a_resample", ids=("A1", "F1"), sql=f"""
SELECT o_orderpriority, period, round(v, {MONEY_DP}) AS v, n, round(avg_price, {MONEY_DP}) AS avg_price
FROM ({P.SQL_A}) t
""")
def q_panel_a(spark, sf):
    a = P.panel_a(spark, sf)
    return a.select("o_orderpriority", "period", rnd("v", MONEY_DP).alias("v"), "n",
                    rnd("avg_price", MONEY_DP).alias("avg_price"))


@register("resample_last", ids=("A1", "Q10"), sql="""
SELECT o_orderpriority, period, o_totalprice AS last_price
FROM (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_totalprice,
             row_number() OVER (PARTITION BY o_orderpriority, date_trunc('month', o_orderdate)
                                ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)) t
WHERE rn = 1
""")
def q_resample_last(spark, sf):
    o = read_table(spark, sf, "orders")
    r = resample_last(o, ["o_orderpriority"], "o_orderdate", ["o_totalprice"], tiebreak=["o_orderkey"])
    return r.select("o_orderpriority", "period", F.col("o_totalprice").alias("last_price"))


@register("resample_day", ids=("A1", "F1"), sql=f"""
SELECT event_type, period, round(v, {MONEY_DP}) AS v FROM ({P.SQL_E}) t
""")
def q_resample_day(spark, sf):
    e = P.panel_e(spark, sf)
    return e.select("event_type", "period", rnd("v", MONEY_DP).alias("v"))


@register("spine_fill", ids=("J7", "A1"), sql=f"""
SELECT n_name, o_orderpriority, period, round(v, {MONEY_DP}) AS v FROM ({P.SQL_C_SPINE}) t
""")
def q_spine_fill(spark, sf):
    c = P.panel_c(spark, sf, spine=True)
    return c.select("n_name", "o_orderpriority", "period", rnd("v", MONEY_DP).alias("v"))


@register("date_filter", ids=("P2", "F2"), sql=f"""
SELECT o_orderpriority, period, round(v, {MONEY_DP}) AS v, n
FROM ({P.SQL_A}) t WHERE period BETWEEN DATE '1996-03-15' AND DATE '1999-06-30'
""")
def q_date_filter(spark, sf):
    # predicate on raw o_orderdate (pushed to the scan) ...
    a = P.panel_a(spark, sf, start="1996-03-15", end="1999-06-30")
    # ... and the inclusive period filter, which is then a no-op guard
    a = date_range_filter(a, "1996-03-15", "1999-06-30")
    return a.select("o_orderpriority", "period", rnd("v", MONEY_DP).alias("v"), "n")


_PIVOT_SQL_COLS = ",\n       ".join(
    f"round(max(v) FILTER (WHERE o_orderpriority = '{k}'), {MONEY_DP}) AS {v}" for k, v in PRIORITY_COLS.items())


@register("pivot_align", ids=("S3", "J1"), sql=f"""
SELECT period,
       {_PIVOT_SQL_COLS}
FROM ({P.SQL_A}) t GROUP BY period
""")
def q_pivot_align(spark, sf):
    a = P.panel_a(spark, sf).select(F.col("o_orderpriority").alias("series_id"), "period", "v")
    w = pivot_align(a, [], "series_id", "period", "v", list(PRIORITY_COLS))
    return w.select("period", *[rnd(F.col(f"`{k}`"), MONEY_DP).alias(v) for k, v in PRIORITY_COLS.items()])


@register("outer_align", ids=("J1", "S3"), sql=f"""
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum(o_totalprice) AS order_value
           FROM orders GROUP BY 1),
     l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_extendedprice) AS shipped_value
           FROM lineitem GROUP BY 1)
SELECT coalesce(o.period, l.period) AS period, round(order_value, {MONEY_DP}) AS order_value,
       round(shipped_value, {MONEY_DP}) AS shipped_value
FROM o FULL OUTER JOIN l ON o.period = l.period
""")
def q_outer_align(spark, sf):
    from panelcast.operators.calendar import resample_agg
    o = resample_agg(read_table(spark, sf, "orders"), [], "o_orderdate", {"order_value": F.sum("o_totalprice")})
    li = resample_agg(read_table(spark, sf, "lineitem"), [], "l_shipdate", {"shipped_value": F.sum("l_extendedprice")})
    j = outer_align([o, li], [])
    return j.select("period", rnd("order_value", MONEY_DP).alias("order_value"),
                    rnd("shipped_value", MONEY_DP).alias("shipped_value"))


@register("panel_d_rates", ids=("A1", "P3"), sql=f"""
SELECT l_returnflag, l_linestatus, period, round(level, {RATIO_DP}) AS level,
       round(rate1, {RATIO_DP}) AS rate1, round(rate2, {RATIO_DP}) AS rate2
FROM ({P.SQL_D}) t
""")
def q_panel_d(spark, sf):
    d = P.panel_d(spark, sf)
    return d.select(*P.PANEL_KEYS["D"], "period", rnd("level").alias("level"),
                    rnd("rate1").alias("rate1"), rnd("rate2").alias("rate2"))


@register("panel_b_join", ids=("J2", "A1"), sql=f"""
SELECT c_nationkey, period, round(v, {MONEY_DP}) AS v FROM ({P.SQL_B}) t
""")
def q_panel_b(spark, sf):
    b = P.panel_b(spark, sf)
    return b.select("c_nationkey", "period", rnd("v", MONEY_DP).alias("v"))


@register("raw_range_scan", ids=("P2", "S2"), sql="""
SELECT o_orderpriority, count(*) AS n_orders, CAST(min(o_orderdate) AS DATE) AS first_day,
       CAST(max(o_orderdate) AS DATE) AS last_day
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY 1
""")
def q_raw_range_scan(spark, sf):
    o = date_range_filter_raw(read_table(spark, sf, "orders"), "o_orderdate", "1997-01-01", "1997-12-31")
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"),
                                            F.to_date(F.min("o_orderdate")).alias("first_day"),
                                            F.to_date(F.max("o_orderdate")).alias("last_day"))
