"""Query registry, shared table access and time parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}
_FAMILIES = ("connectors", "rows", "keyed", "windows", "ranking", "joins", "patterns", "functions")


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register ``run(spark, sf_dir)`` under ``name`` with its ANSI SQL oracle."""

    def register(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        REGISTRY[name] = Query(configured, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for family in _FAMILIES:
        import_module(f"tidemark.plans.{family}")


def queries() -> dict[str, Run]:
    _load()
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
