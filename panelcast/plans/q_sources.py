"""Stage 1 source queries: long-series scan with pushdown, source fallback."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from panelcast.plans import panels as P
from panelcast.plans.catalog import register
from panelcast.plans.sqlbits import MONEY_DP, rnd
from panelcast.sources.io import load_with_fallback, read_long_series
from panelcast.sources.tables import table_path

LONG_IDS = ["click", "view"]


@register("long_series_scan", ids=("S2", "P2"), sql="""
SELECT event_type AS series_id, ts AS date, value
FROM events WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'
""")
def q_long_series_scan(spark, sf):
    df = read_long_series(spark, table_path(sf, "events"), LONG_IDS, "2024-01-05", "2024-01-20",
                          id_col="event_type", time_col="ts", value_col="value", freq="day")
    return df.select(F.col("event_type").alias("series_id"), F.col("ts").alias("date"), "value")


@register("source_fallback", ids=("S4",), sql=f"""
SELECT o_orderpriority, period, round(v, {MONEY_DP}) AS v, 'orders_parquet' AS source_used FROM ({P.SQL_A}) a
""")
def q_source_fallback(spark, sf):
    missing = os.path.join(sf, "no_such_table.parquet")
    df, used = load_with_fallback(lambda: spark.read.parquet(missing), lambda: P.panel_a(spark, sf),
                                  source="auto", names=("primary_file", "orders_parquet"))
    return df.select("o_orderpriority", "period", rnd("v", MONEY_DP).alias("v"), F.lit(used).alias("source_used"))


@register("csv_series_scan", ids=("S1", "P1"), sql=f"""
SELECT o_orderpriority, period, round(v, {MONEY_DP}) AS v, CAST(n AS DOUBLE) AS n FROM ({P.SQL_A}) a
""")
def q_csv_series_scan(spark, sf):
    """Panel A written as CSV files into the shared folder and read by the CSV source, one column per series."""
    import uuid

    from panelcast.session import ensure_checkpoint_dir
    from panelcast.sources.io import read_csv_series
    ensure = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{ensure}/csv-{uuid.uuid4().hex}"
    a = P.panel_a(spark, sf).select(F.col("period").alias("date"), "o_orderpriority", "v", "n")
    a.write.option("header", True).partitionBy("o_orderpriority").csv(path)
    names = [r[0] for r in a.select("o_orderpriority").distinct().collect()]  # five priorities
    parts = [read_csv_series(spark, f"{path}/o_orderpriority={x}", ["v", "n"]).withColumn("o_orderpriority", F.lit(x)) for x in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("o_orderpriority", F.col("date").alias("period"), rnd("v", MONEY_DP).alias("v"), "n")
