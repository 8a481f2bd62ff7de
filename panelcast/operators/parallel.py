"""Independent Spark ML fits side by side: small fits leave most of a cluster idle, one after another."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

R = TypeVar("R")


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], R]], parallelism: int) -> list[R]:
    """Results of the jobs in order; at most ``parallelism`` run at once, the first failure ends them all."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    target = inheritable_thread_target(spark)  # job groups and local properties of the calling thread go along
    with ThreadPoolExecutor(min(parallelism, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(target(job)) for job in jobs]]
