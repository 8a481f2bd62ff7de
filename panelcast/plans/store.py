"""Run store: the tables of a run, written once under its id and read by whatever comes later.

``<root>/<run_id>/tables/<name>`` holds one Parquet table each, ``models/<name>`` the
fitted models and ``manifest`` one JSON row, written last: a run without it did not finish and
is not opened. Every table is read back from its files, so nothing stays cached,
later steps restart from files after a loss, and another session finds the run by its id.
The default root lies in the session's checkpoint directory, a folder that all executors share.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from panelcast.session import ensure_checkpoint_dir
from panelcast.sources.io import ModelStore

_MANIFEST = "run_id string, timestamp string, config_hash string, config string, tables array<string>, models array<string>"


class StoredRun:
    """One run's tables and models. ``manifest`` is None until ``finish``."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict | None = None):
        self.spark, self.path, self.manifest = spark, path, manifest
        self.models = ModelStore(spark, f"{path}/models")
        self._tables: dict[str, DataFrame] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table and gives it back as read from its files."""
        target = f"{self.path}/tables/{name}"
        df.write.mode("errorifexists").parquet(target)
        self._tables[name] = self.spark.read.schema(df.schema).parquet(target)
        return self._tables[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if self.manifest is None or name not in self.manifest["tables"]:
                raise KeyError(f"run {self.path} has no table '{name}'")
            self._tables[name] = self.spark.read.parquet(f"{self.path}/tables/{name}")
        return self._tables[name]

    def finish(self, meta: Mapping, config: Mapping) -> None:
        row = {**{k: meta[k] for k in ("run_id", "timestamp", "config_hash")}, "config": json.dumps(config, sort_keys=True, default=str),
               "tables": sorted(self._tables), "models": self.models.names()}
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.json(f"{self.path}/manifest")
        self.manifest = row


class RunStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{ensure_checkpoint_dir(spark)}/runs").rstrip("/")

    def begin(self, run_id: str) -> StoredRun:
        return StoredRun(self.spark, f"{self.root}/{run_id}")

    def open(self, run_id: str) -> StoredRun:
        """A finished run; ``KeyError`` if there is none of that id."""
        path = f"{self.root}/{run_id}"
        try:
            found = self.spark.read.schema(_MANIFEST).json(f"{path}/manifest").first()
        except AnalysisException as exc:
            raise KeyError(f"no finished run '{run_id}' in {self.root}") from exc
        return StoredRun(self.spark, path, found.asDict())

    def runs(self) -> DataFrame:
        """The manifests of all finished runs under the root."""
        return self.spark.read.schema(_MANIFEST).json(f"{self.root}/*/manifest")
