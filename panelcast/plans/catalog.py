"""Registry of named queries: a Spark builder and (when SQL can express it)
the equivalent DuckDB SQL used as the correctness oracle.

Every query reads the driver tables (or panels Spark derives from them) in
full; nothing is sampled, capped or filtered by id to keep it cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        from panelcast.plans.sqlbits import rewrite_round
        REGISTRY[name] = Query(name, fn, rewrite_round(sql) if sql else None, ids)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql}


def _load_all():
    # importing the modules fills REGISTRY
    from panelcast.plans import q_arima, q_calendar, q_evaluate, q_features, q_forecast, q_models, q_quality, q_misc, q_panels, q_report, q_sources  # noqa: F401
