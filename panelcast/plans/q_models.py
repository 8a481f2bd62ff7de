"""Stage 7 queries: sequence windows, scaling, chronological split, tree
ensembles and the window regressor (model fits: rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import sequence as S
from panelcast.operators import trees as T
from panelcast.plans.catalog import register
from panelcast.plans.featuresets import KD, TARGET_D, feature_columns_d, features_d, sql_features_d
from panelcast.plans.sqlbits import rnd
from panelcast.session import ensure_checkpoint_dir

KEYS_SQL = ", ".join(KD)
L = 3
DP = 6
W_SQL = f"PARTITION BY {KEYS_SQL} ORDER BY period"

# Size of the registered searches, an argument of the operator; stated in the backtests' results. Boosting's is the
# reference's (100 to 500 trees), the forest's is smaller.
SEARCH = dict(n_trials=20, cv_splits=3, space=T.GBT_SPACE)
RF_SEARCH = dict(n_trials=2, cv_splits=2, space={"n_estimators": [10, 20]})
SEQUENCE_ROUNDS = 20


@register("seq_windows", ids=("W7",), sql=f"""
SELECT {KEYS_SQL}, period, {', '.join(f'round(lag({TARGET_D}, {i}) OVER ({W_SQL}), {DP}) AS x_l{i}' for i in range(L, 0, -1))},
       round({TARGET_D}, {DP}) AS label
FROM ({sql_features_d()}) f QUALIFY row_number() OVER ({W_SQL}) > {L}
""")
def q_seq_windows(spark, sf):
    w = S.sequence_windows(features_d(spark, sf), KD, [TARGET_D], TARGET_D, L)
    return w.select(*KD, "period", *[rnd(F.col("window")[L - i][TARGET_D], DP).alias(f"x_l{i}") for i in range(L, 0, -1)],
                    rnd("label", DP).alias("label"))


@register("scoring_windows", ids=("W8",), sql=f"""
SELECT {KEYS_SQL}, period, {', '.join(f'round(coalesce(lag({TARGET_D}, {i}) OVER ({W_SQL}), 0.0), {DP}) AS x_l{i}' for i in range(L - 1, -1, -1))}
FROM ({sql_features_d()}) f
""")
def q_scoring_windows(spark, sf):
    w = S.scoring_windows(features_d(spark, sf), KD, [TARGET_D], L)
    return w.select(*KD, "period", *[rnd(F.col("window")[L - 1 - i][TARGET_D], DP).alias(f"x_l{i}") for i in range(L - 1, -1, -1)])


_MM = ["rate1", "rate2"]


@register("minmax_scale", ids=("E15",), sql=f"""
SELECT {KEYS_SQL}, period, {', '.join(f"round(CASE WHEN mx_{c} > mn_{c} THEN ({c} - mn_{c}) / (mx_{c} - mn_{c}) ELSE 0.0 END, {DP}) AS {c}_scaled" for c in _MM)}
FROM ({sql_features_d()}) f
LEFT JOIN (SELECT {KEYS_SQL}, {', '.join(f'min({c}) AS mn_{c}, max({c}) AS mx_{c}' for c in _MM)}
           FROM ({sql_features_d()}) g WHERE period < DATE '2000-01-01' GROUP BY {KEYS_SQL}) s USING ({KEYS_SQL})
""")
def q_minmax(spark, sf):
    f = features_d(spark, sf)
    st = S.minmax_fit(f, KD, _MM, F.col("period") < F.to_date(F.lit("2000-01-01")))
    out = S.minmax_apply(f, st, KD, _MM)
    return out.select(*KD, "period", *[rnd(f"{c}_scaled", DP).alias(f"{c}_scaled") for c in _MM])


@register("time_split", ids=("E17",), sql=f"""
SELECT {KEYS_SQL}, period,
       row_number() OVER ({W_SQL}) > count(*) OVER (PARTITION BY {KEYS_SQL}) - greatest(1, floor(count(*) OVER (PARTITION BY {KEYS_SQL}) * 0.15)) AS is_validation
FROM ({sql_features_d()}) f
""")
def q_time_split(spark, sf):
    return S.time_split(features_d(spark, sf), KD, 0.15).select(*KD, "period", "is_validation")


def _tree_preds(spark, sf, variant, name, search):
    p, _ = T.fit_predict_folds(features_d(spark, sf), KD, TARGET_D, feature_columns_d(), variant=variant,
                               model_name=name, **search)
    return p.select(*KD, "model", "fold_idx", "period", rnd("y_true", DP).alias("y_true"),
                    rnd("y_pred", DP).alias("y_pred"), F.lit(search["n_trials"]).alias("search_trials"),
                    F.lit(search["cv_splits"]).alias("search_splits"), F.lit(max(search["space"]["n_estimators"])).alias("search_most_trees"))


def _winner(spark, sf):
    """The search's winner on all rows, fitted on them. The feature table is a few rows of a scan of all
    lineitem rows and read many times, so it is made once."""
    ensure_checkpoint_dir(spark)
    feats, cols = features_d(spark, sf).checkpoint(), feature_columns_d()
    params = T.search(feats, KD, TARGET_D, cols, **SEARCH)
    return feats, cols, T.fit_full(feats, KD, TARGET_D, cols, params)


@register("gbt_backtest", ids=("E10", "E12", "T6", "B2"))
def q_gbt_backtest(spark, sf):
    return _tree_preds(spark, sf, "gbt", "GradientBoosting", SEARCH)


@register("rf_backtest", ids=("E11", "E12", "B2"))
def q_rf_backtest(spark, sf):
    return _tree_preds(spark, sf, "rf", "RandomForest", RF_SEARCH)


@register("tree_importances", ids=("E14", "T2"))
def q_importances(spark, sf):
    _, cols, model = _winner(spark, sf)
    return T.importances(spark, model, [*cols, T.SERIES_LEVEL])


@register("tree_scoring_fill", ids=("E13", "P10", "P12"), sql=f"""
SELECT {KEYS_SQL}, period, round(coalesce(last_value(level_yoy_roll_std_3 IGNORE NULLS) OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0), {DP}) AS level_yoy_roll_std_3
FROM ({sql_features_d()}) f
""")
def q_scoring_fill(spark, sf):
    f = T.scoring_fill(features_d(spark, sf), KD, ["level_yoy_roll_std_3"])
    return f.select(*KD, "period", rnd("level_yoy_roll_std_3", DP).alias("level_yoy_roll_std_3"))


@register("sequence_backtest", ids=("E16", "E18", "W7", "E15", "E17", "Q4", "Q5"))
def q_sequence_backtest(spark, sf):
    p = S.sequence_backtest(features_d(spark, sf), KD, TARGET_D, feature_columns_d(), lookback=12, max_iter=SEQUENCE_ROUNDS)
    return p.select(*KD, "model", "fold_idx", "period", rnd("y_true", DP).alias("y_true"),
                    rnd("y_pred", DP).alias("y_pred"), F.lit(SEQUENCE_ROUNDS).alias("most_rounds"))


@register("tree_recursive_forecast", ids=("R1", "E13", "W11", "W12"))
def q_tree_recursive_forecast(spark, sf):
    """The searched GBT rolled forward 12 months per series (target lags
    refreshed from the prediction buffer, other features held)."""
    from panelcast.operators.forecast import recursive_model_forecast
    feats, cols, model = _winner(spark, sf)
    state = T.forecast_state(feats, KD, TARGET_D, cols, 6)
    f = recursive_model_forecast(state, KD, TARGET_D, [*cols, T.SERIES_LEVEL], model, 12)
    return f.select(*KD, "step", "period", rnd("yhat", DP).alias("yhat"))


# ---- a boosted tree that SQL can check: all values are bins, so the split search is exact ----------
_SHAPE = ("quantity", "discount", "tax")
_SHAPE_SQL = """SELECT floor(l_quantity / 2) AS quantity, round(l_discount * 100, 0) AS discount, round(l_tax * 100, 0) AS tax,
       l_extendedprice AS label FROM lineitem"""


def _level_sql(rows: str, level: int) -> str:
    """One level of the search: a histogram per node and feature, running sums, the split with the largest fall of squared error."""
    bins = " UNION ALL ".join(f"SELECT node, '{f}' AS f, {i} AS fi, {f} AS v, count(*) AS n, sum(label) AS s FROM {rows} GROUP BY node, {f}"
                              for i, f in enumerate(_SHAPE))
    past, whole = "OVER (PARTITION BY node, f ORDER BY v)", "OVER (PARTITION BY node, f)"
    return f"""best{level} AS (SELECT node, f, v, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM (
  SELECT node, f, fi, v, sum(n) {past} AS nl, sum(s) {past} AS sl, sum(n) {whole} AS n, sum(s) {whole} AS s FROM ({bins}) b) c
  WHERE nl < n QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, fi, v) = 1),
rows{level} AS (SELECT r.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN r.node * 2
  WHEN CASE b.f {' '.join(f"WHEN '{f}' THEN r.{f}" for f in _SHAPE)} END > b.v THEN r.node * 2 + 1 ELSE r.node * 2 END AS node
  FROM {rows} r LEFT JOIN best{level} b USING (node))"""


_TREE_SQL = f"WITH rows0 AS (SELECT *, 1 AS node FROM ({_SHAPE_SQL}) l), {_level_sql('rows0', 1)}, {_level_sql('rows1', 2)}"


def _shape_tree(spark, sf):
    from pyspark.ml.feature import VectorAssembler

    from panelcast.sources.tables import read_table

    rows = read_table(spark, sf, "lineitem").select(
        F.floor(F.col("l_quantity") / 2).cast("double").alias("quantity"), F.round(F.col("l_discount") * 100).alias("discount"),
        F.round(F.col("l_tax") * 100).alias("tax"), F.col("l_extendedprice").cast("double").alias("label"))
    ready = VectorAssembler(inputCols=list(_SHAPE), outputCol="features").transform(rows)
    one = T.make_estimator("gbt", {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.1, "subsample": 1.0})
    return ready, one.fit(ready)


@register("tree_depth2", ids=("E10", "E11", "E13"), sql=f"""{_TREE_SQL}
SELECT round(avg(label), 2) AS prediction, count(*) AS n FROM rows2 GROUP BY node""")
def q_tree_depth2(spark, sf):
    """The boosting estimator's first tree, two levels deep, over all lineitem rows: its leaves."""
    ready, model = _shape_tree(spark, sf)
    return model.transform(ready).groupBy(rnd("prediction", 2).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@register("tree_depth2_importances", ids=("E14", "T2"), sql=f"""{_TREE_SQL},
g AS (SELECT f, gain FROM best1 UNION ALL SELECT f, gain FROM best2)
SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM g), 6) AS importance
FROM (SELECT unnest([{', '.join(f"'{f}'" for f in _SHAPE)}]) AS feature) x LEFT JOIN g ON f = feature GROUP BY feature""")
def q_tree_depth2_importances(spark, sf):
    _, model = _shape_tree(spark, sf)
    return T.importances(spark, model, list(_SHAPE)).select("feature", rnd("importance", 6).alias("importance"))
