"""Named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, when the
result is expressible in SQL, the DuckDB oracle text over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from unitmesh.plans import fixtures as fx

# SCL10: stand-ins for the reference's now() / today, so results are reproducible.
RUN_TS = "2024-06-30 12:00:00"
TODAY = "2024-06-30"


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register ``fn`` under ``name`` with its oracle (fixtures inlined as CTEs)."""

    def deco(fn):
        text = fx.oracle(sql, list(fixtures)) if sql and fixtures else (sql.strip() if sql else None)
        REGISTRY[name] = Query(name, fn, text, (fn.__doc__ or "").strip())
        return fn

    return deco
