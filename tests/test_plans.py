"""Plan-shape checks: pushdown, pruning, exchange counts."""

from panelcast.plans import panels as P
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_filter_reaches_scan(spark):
    a = P.panel_a(spark, SF_SMALL, start="1996-03-15", end="1999-06-30")
    txt = plan(a)
    assert "PushedFilters" in txt and "GreaterThanOrEqual(o_orderdate" in txt and "LessThan(o_orderdate" in txt


def test_column_pruning(spark):
    txt = plan(P.panel_a(spark, SF_SMALL))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in txt


def test_spine_keeps_key_partitioning(spark):
    from panelcast.operators.features import add_lags
    c = add_lags(P.panel_c(spark, SF_SMALL, spine=True), P.PANEL_KEYS["C"], ["v"], 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txt = plan(c)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # exchanges: fact pre-aggregate, joins, final aggregate, ONE on the series keys
    key_exchanges = [ln for ln in txt.splitlines() if "Exchange hashpartitioning(n_name" in ln and "period" not in ln]
    assert len(key_exchanges) == 1
