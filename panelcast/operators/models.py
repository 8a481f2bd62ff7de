"""OLS as a fitted object over DataFrames.

``OlsModel`` has ``name``, ``fit(df) -> fitted`` and ``predict(df, fitted)``: the fitted
state is a one-row-per-series coefficient table, and prediction is a keyed
join plus a sum of products. What a run needs of any model (backtest, fit, forecast) is
``plans.forecasters.Forecaster``.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelcast.functions.dual import SparkRel
from panelcast.operators import ols


class OlsModel:
    """OLS per series with Newey-West errors; predictions NULL when any
    regressor is missing."""

    def __init__(self, keys: Sequence[str], y: str, regressors: Sequence[str], hac_lags: int = 6,
                 name: str = "OLS", complete_cols: Sequence[str] = ()):
        self.keys, self.y, self.xs, self.hac_lags, self.name = list(keys), y, list(regressors), hac_lags, name
        self.complete_cols = list(complete_cols)

    def fit_table(self, df: DataFrame) -> DataFrame:
        return ols.fit(SparkRel(df), self.keys, self.y, self.xs, self.hac_lags, self.complete_cols).df

    def fit(self, df: DataFrame) -> DataFrame:
        f = self.fit_table(df)
        return f.select(*self.keys, F.col("_obeta_const").alias("coef_const"),
                        *[F.col(f"_obeta{j}").alias(f"coef_{x}") for j, x in enumerate(self.xs)])

    def predict(self, df: DataFrame, fitted: DataFrame) -> DataFrame:
        """Keyed join of the coefficients (one row per series; Spark picks
        broadcast only when its size estimate is under the threshold)."""
        yhat = F.col("coef_const")
        for x in self.xs:
            yhat = yhat + F.col(f"coef_{x}") * F.col(x)
        j = df.join(fitted, on=self.keys, how="inner")
        return j.select(*self.keys, "period", yhat.alias("y_pred"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns (the reference keeps only those as features)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with no missing value in ``cols`` (``na.drop('any')``; NaN counts)."""
    return df.na.drop(how="any", subset=list(cols))


def align_target(features: DataFrame, target: DataFrame, keys: Sequence[str], period_col: str = "period") -> DataFrame:
    """Target rows whose feature row survived cleaning (a left-semi join)."""
    return target.join(features.select(*keys, period_col), on=[*keys, period_col], how="left_semi")
