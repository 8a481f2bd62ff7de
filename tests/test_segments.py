"""Segment by segment gives the rows of the plain windows, in several tasks for one key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import segments as G
from panelcast.operators.calendar import fill_spine
from panelcast.operators.features import build_features
from panelcast.operators.quality import DataQualityError, gap_report, impute
from panelcast.plans.pipeline import RunConfig, given, load, run

START = {"day": dt.date(1969, 11, 3), "month": dt.date(1969, 11, 1), "hour": dt.datetime(1969, 12, 30, 5)}


def step(freq, n):
    if freq == "day":
        return START[freq] + dt.timedelta(days=n)
    if freq == "hour":
        return START[freq] + dt.timedelta(hours=n)
    return dt.date(1969 + (10 + n) // 12, (10 + n) % 12 + 1, 1)


def panel(spark, freq, keys="ab", n=300, seed=1, empty=0.2, gone=0.1, hole=(120, 200)):
    rng = random.Random(seed)
    rows = [(k, step(freq, i), None if rng.random() < empty else rng.uniform(50, 150), rng.uniform(-1, 1)) for k in keys for i in range(n)
            if not hole[0] <= i < hole[1] and rng.random() > gone]
    return spark.createDataFrame(rows, f"k string, period {'timestamp_ntz' if freq == 'hour' else 'date'}, v double, x double")


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("freq", ["day", "month", "hour"])
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("size", [7, 64])
def test_same_rows_as_plain_windows(spark, freq, keys, size):
    p = panel(spark, freq, "ab" if keys else "a", 160, hole=(60, 95))
    p = p if keys else p.drop("k")
    plain, cut = fill_spine(p, keys, freq), G.segmented_spine(p, keys, freq, size)
    assert rows(cut) == rows(plain)
    for threshold in (5.0, 99.0):
        assert rows(G.segmented_impute(plain, keys, ["v", "x"], threshold, freq, size)) == rows(impute(plain, keys, ["v", "x"], threshold))
    full = impute(plain, keys, ["v", "x"]).checkpoint()
    want = build_features(full, keys, "v", "g", ["x"], None, 4, [3, 9], True, 12)
    assert rows(G.segmented_features(full, keys, "v", "g", ["x"], 4, [3, 9], True, 12, freq, size)) == rows(want)


@pytest.fixture()
def whole_partitions(spark):
    """The tables are so small that their partitions would be put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_key_takes_several_tasks(spark, whole_partitions):
    p = panel(spark, "day", "a", 2000, hole=(0, 0)).drop("k")
    out = G.segmented_features(p.na.drop(), [], "v", "g", ["x"], freq="day", size=100)
    spread = out.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    assert spread > 1


def test_a_timestamp_a_century_off_is_an_error_before_anything_is_filled(spark, whole_partitions):
    p = panel(spark, "day", "ab", 60, hole=(0, 0)).filter("k = 'a' OR period < '1969-12-30'")
    off = p.unionByName(spark.createDataFrame([("b", dt.date(2069, 11, 3), 1.0, 1.0)], p.schema))
    bad = gap_report(off, ["k"], "day", 1200).collect()
    assert [(r.k, r.check, r.severity, r.n_bad) for r in bad] == [("b", "gap_too_long", "error", 1)]
    assert gap_report(p, ["k"], "day", 1200).isEmpty()
    cfg = RunConfig(keys=["k"], level_col="v", target="g", exog=["x"], regressors=["x"], freq="day", min_obs=10)
    with pytest.raises(DataQualityError, match="gap_too_long"):
        run(spark, off, cfg)
    cut = RunConfig(**{**cfg.__dict__, "segment": 512})
    assert load(off, cut).filter("k = 'b'").count() == (dt.date(2069, 11, 3) - dt.date(1969, 11, 3)).days + 1 - (
        given(off, cfg).filter("k = 'b'").agg(F.min("period")).first()[0] - dt.date(1969, 11, 3)).days
    pieces = G.segmented_spine(off, ["k"], "day", 512).withColumn("task", F.spark_partition_id())
    assert pieces.filter("k = 'b'").select("task").distinct().count() > 2
