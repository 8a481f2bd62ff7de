"""Sources: CSV and long-format series files, source fallback, model registry and store.

All scans are lazy; filters on the series id and the date range are plain
predicates on raw columns, so Catalyst pushes them into the Parquet scan
(and prunes partitions when the files are partitioned by series id).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.align import pivot_align
from panelcast.operators.calendar import date_range_filter_raw

log = logging.getLogger(__name__)


def read_csv_series(spark: SparkSession, path: str, value_cols: Sequence[str], date_col: str = "date",
                    date_format: str | None = None) -> DataFrame:
    """CSV with a header and a date column; values coerced to DOUBLE.

    Values are read as text and converted with ``try_cast`` (a bad value
    becomes NULL instead of failing the job). A missing path raises
    ``FileNotFoundError``.
    """
    schema = T.StructType([T.StructField(date_col, T.StringType())] +
                          [T.StructField(c, T.StringType()) for c in value_cols])
    try:
        df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
        df.schema  # noqa: B018  (resolve now so a missing path fails here)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"CSV not found at '{path}'") from exc
        raise
    d = F.to_date(F.col(date_col), date_format) if date_format else F.to_date(F.col(date_col))
    return df.select(d.alias(date_col), *[F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) for c in value_cols])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bad values -> NULL (``try_cast``; plain ``cast`` fails under ANSI mode)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})


def read_long_series(spark: SparkSession, path: str, series_ids: Sequence[str] | None = None, start=None,
                     end=None, id_col: str = "series_id", time_col: str = "date", value_col: str = "value",
                     fmt: str = "parquet", freq: str = "month") -> DataFrame:
    """Long ``(series_id, date, value)`` table restricted to ids and dates.

    Both restrictions are predicates on raw columns with literal values,
    pushed into the scan.
    """
    df = spark.read.format(fmt).load(path)
    if series_ids is not None:
        df = df.filter(F.col(id_col).isin(list(series_ids)))
    df = date_range_filter_raw(df, time_col, start, end, freq)
    return df.select(id_col, time_col, F.col(value_col).cast("double").alias(value_col))


def fetch_all(spark: SparkSession, path: str, series_ids: Sequence[str], start=None, end=None,
              id_col: str = "series_id", time_col: str = "date", value_col: str = "value",
              fmt: str = "parquet", keys: Sequence[str] = ()) -> DataFrame:
    """Many series aligned on the date: full outer semantics via one pivot."""
    long = read_long_series(spark, path, series_ids, start, end, id_col, time_col, value_col, fmt)
    return pivot_align(long, list(keys), id_col, time_col, value_col, list(series_ids))


def load_with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame],
                       source: str = "auto", primary_available: bool = True,
                       names: tuple[str, str] = ("primary", "fallback")) -> tuple[DataFrame, str]:
    """Choose a source: ``auto`` tries the primary when available and falls
    back on any error; ``primary`` re-raises its errors but falls back (with
    a warning) when the primary is unavailable; ``fallback`` uses the
    fallback. The chosen plan is analysed inside the ``try`` so that
    analysis errors (missing path, bad schema) trigger the fallback.
    """
    if source not in ("auto", "primary", "fallback"):
        raise ValueError(f"unknown source {source!r}")
    if source in ("auto", "primary") and primary_available:
        try:
            df = primary()
            df.schema  # noqa: B018
            return df, names[0]
        except Exception as exc:  # noqa: BLE001
            if source == "primary":
                raise
            log.warning("primary source failed (%s); using %s", exc, names[1])
    elif source == "primary":
        log.warning("primary source unavailable; using %s", names[1])
    df = fallback()
    return df, names[1]


class ModelRegistry:
    """Named fitted models of one session: tables (one row per series) or Spark ML models.
    Unknown names raise ``KeyError``."""

    def __init__(self):
        self._models: dict[str, object] = {}

    def register(self, name: str, model: object) -> None:
        self._models[name] = model

    def get(self, name: str):
        if name not in self._models:
            raise KeyError(f"Model '{name}' not found in registry. Available: {self.list_models()}")
        return self._models[name]

    def list_models(self) -> list[str]:
        return list(self._models)

    def save(self, path: str, spark: SparkSession) -> None:
        store = ModelStore(spark, path)
        for name, m in self._models.items():
            store.save(name, m)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "ModelRegistry":
        """The models another session saved."""
        out, store = cls(), ModelStore(spark, path)
        for name in store.names():
            out.register(name, store.load(name))
        return out


class ModelStore:
    """Fitted models by name in a folder that all executors reach: ``<root>/<name>/table`` (Parquet) or
    ``<root>/<name>/ml`` (Spark ML's own format). Another session loads them by name."""

    KINDS = ("table", "ml")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def save(self, name: str, model: DataFrame | Model) -> DataFrame | Model:
        """Saves a model and gives it back as loaded, so that what is used is what is kept."""
        if isinstance(model, DataFrame):
            model.write.mode("overwrite").parquet(f"{self.root}/{name}/table")
        elif hasattr(model, "write"):
            PipelineModel([model]).write().overwrite().save(f"{self.root}/{name}/ml")
        else:
            raise TypeError(f"cannot save model {name} of type {type(model).__name__}")
        return self.load(name)

    def load(self, name: str) -> DataFrame | Model:
        for kind in self.KINDS:
            fs, path = self._fs(f"{self.root}/{name}/{kind}")
            if fs.exists(path):
                if kind == "table":
                    return self.spark.read.parquet(f"{self.root}/{name}/{kind}")
                return PipelineModel.load(f"{self.root}/{name}/{kind}").stages[0]
        raise KeyError(f"Model '{name}' not found in {self.root}. Available: {self.names()}")

    def names(self) -> list[str]:
        fs, path = self._fs(self.root)
        return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []
