import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators.evaluate import fold_rows, folds


def series(spark, n, key="a"):
    rows = []
    for i in range(n):
        y, m = 2000 + i // 12, i % 12 + 1
        rows.append((key, dt.date(y, m, 1), float(i)))
    return spark.createDataFrame(rows, "key string, period date, y double")


def test_fold_bounds_match_reference_split(spark):
    n, K, h = 40, 3, 3
    f = folds(series(spark, n), ["key"], K, h).orderBy("fold_idx").collect()
    assert [r.fold_idx for r in f] == [0, 1, 2]
    for r in f:
        test_end = n - (K - 1 - r.fold_idx) * h
        assert r.test_end == test_end and r.test_start == test_end - h
        assert r.train_end == r.test_start  # train is [0, test_start)


def test_short_series_has_no_folds(spark):
    df = series(spark, 11, "short").unionByName(series(spark, 40, "long"))
    keys = {r.key for r in folds(df, ["key"], 3, 3).collect()}
    assert keys == {"long"}


def test_fold_rows_never_train_on_test(spark):
    fr = fold_rows(series(spark, 40), ["key"], 3, 3)
    agg = fr.groupBy("fold_idx").agg(F.max(F.when(F.col("role") == "train", F.col("pos"))).alias("tr"),
                                     F.min(F.when(F.col("role") == "test", F.col("pos"))).alias("te"),
                                     F.count(F.when(F.col("role") == "test", 1)).alias("nt")).collect()
    for r in agg:
        assert r.tr < r.te and r.nt == 3
