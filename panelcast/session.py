"""Spark session helpers.

Cluster settings win: nothing here overrides a value the session already
has. Local defaults apply only when a setting is unset (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults for a local run; a cluster's own configuration takes precedence.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "panelcast") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    memory = os.environ.get("PANELCAST_DRIVER_MEMORY")  # must be known before the JVM starts
    if memory:
        os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--driver-memory {memory} pyspark-shell")
    SparkContext._ensure_initialized()
    given = SparkConf()  # with the JVM up: what spark-submit and spark-defaults.conf set
    builder = SparkSession.builder.appName(app_name)
    named = given.get("spark.master", "local[*]")  # spark-submit itself fills in local[*] where nobody named a master
    if master and named == "local[*]":
        builder = builder.master(master)
    wanted = {**LOCAL_DEFAULTS, **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})}
    for k, v in wanted.items():
        if not given.contains(k) or k == "spark.ui.showConsoleProgress" and named.startswith("local"):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder that survives executor
    loss. Only when nothing is configured (local tests) do we pick a fresh
    scratch directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="panelcast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
