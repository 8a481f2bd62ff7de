"""Panels built from the driver tables (many series keyed by columns).

Each builder returns ``(keys..., period, values...)`` at one row per
(key, period). The small dimension columns are joined first (Spark broadcasts
them by size, and splits a skewed shuffle join); the partial aggregate on
the series keys then collapses the fact table before its only shuffle.

``SQL_*`` strings are the same panels in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.columns import period_of
from panelcast.operators.calendar import date_range_filter_raw, fill_spine, resample_agg
from panelcast.sources.tables import read_table

PANEL_KEYS = {
    "A": ["o_orderpriority"],
    "B": ["c_nationkey"],
    "C": ["n_name", "o_orderpriority"],
    "D": ["l_returnflag", "l_linestatus"],
    "E": ["event_type"],
    "S": ["l_suppkey"],
}


def panel_a(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """orders by priority and month: total price, order count, mean price."""
    o = read_table(spark, sf_dir, "orders")
    o = date_range_filter_raw(o, "o_orderdate", start, end, "month")
    return resample_agg(o, ["o_orderpriority"], "o_orderdate", {
        "v": F.sum("o_totalprice"),
        "n": F.count(F.lit(1)),
        "avg_price": F.avg("o_totalprice"),
    })


def _orders(spark, sf_dir, *columns):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_custkey", *columns, period_of("o_orderdate").alias("period"), "o_totalprice")


def panel_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer, by nation and month (sum of price)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = _orders(spark, sf_dir).join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return j.groupBy("c_nationkey", "period").agg(F.sum("o_totalprice").alias("v"))


def panel_c(spark: SparkSession, sf_dir: str, spine: bool = False) -> DataFrame:
    """orders x customer x nation by (nation name, priority) and month."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner").select("c_custkey", "n_name")
    j = _orders(spark, sf_dir, "o_orderpriority").join(named, F.col("o_custkey") == F.col("c_custkey"), "inner")
    out = j.groupBy("n_name", "o_orderpriority", "period").agg(F.sum("o_totalprice").alias("v"))
    return fill_spine(out, PANEL_KEYS["C"]) if spine else out


def panel_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by (returnflag, linestatus) and ship month: a level and two rates."""
    li = read_table(spark, sf_dir, "lineitem")
    g = resample_agg(li, PANEL_KEYS["D"], "l_shipdate", {
        "_px": F.sum("l_extendedprice"),
        "_qty": F.sum("l_quantity"),
        "rate1": F.avg("l_discount") * F.lit(100.0),
        "rate2": F.avg("l_tax") * F.lit(100.0),
    })
    return g.select(*PANEL_KEYS["D"], "period",
                    F.try_divide(F.col("_px"), F.col("_qty")).alias("level"), "rate1", "rate2")


def panel_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events by type and day: sum of value."""
    ev = read_table(spark, sf_dir, "events")
    return resample_agg(ev, ["event_type"], "ts", {"v": F.sum("value")}, freq="day")


def panel_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by supplier and ship month: as many series as suppliers, with gaps."""
    li = read_table(spark, sf_dir, "lineitem")
    return resample_agg(li, PANEL_KEYS["S"], "l_shipdate", {"v": F.sum("l_extendedprice")})


# ---- the same panels in DuckDB SQL (oracle side) -------------------------

SQL_A = """
SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
       sum(o_totalprice) AS v, count(*) AS n, avg(o_totalprice) AS avg_price
FROM orders GROUP BY 1, 2
"""

SQL_B = """
SELECT c.c_nationkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
       sum(o.o_totalprice) AS v
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2
"""

SQL_C = """
SELECT n.n_name, o.o_orderpriority, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
       sum(o.o_totalprice) AS v
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3
"""

SQL_D = """
SELECT l_returnflag, l_linestatus, CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
       sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS level,
       avg(l_discount) * 100.0 AS rate1, avg(l_tax) * 100.0 AS rate2
FROM lineitem GROUP BY 1, 2, 3
"""

SQL_E = """
SELECT event_type, CAST(ts AS DATE) AS period, sum(value) AS v
FROM events GROUP BY 1, 2
"""

SQL_S = """
SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_extendedprice) AS v
FROM lineitem GROUP BY 1, 2
"""

# panel C with the per-series calendar filled (NULL v in empty months)
SQL_C_SPINE = f"""
WITH c AS ({SQL_C}),
b AS (SELECT n_name, o_orderpriority, min(period) AS lo, max(period) AS hi FROM c GROUP BY 1, 2),
g AS (SELECT n_name, o_orderpriority,
             CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period
      FROM b)
SELECT g.n_name, g.o_orderpriority, g.period, c.v
FROM g LEFT JOIN c USING (n_name, o_orderpriority, period)
"""
