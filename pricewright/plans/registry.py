"""Query registry: a name, the inventory ids it covers, a builder and the checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pricewright.plans.views import Tables, fill_sql


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a builder. ``{view}`` placeholders in the SQL become checking views."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, tuple(ids.split()), build, fill_sql(sql) if sql else None)
        return build

    return register


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Tables(spark, sf_dir))

    run.__name__ = q.name
    return run
