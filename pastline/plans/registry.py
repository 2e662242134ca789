"""Registry of named queries: a Spark builder and, where SQL can say the same
thing, an oracle SQL text over the given tables (stand-in views as CTEs)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.sources.fixtures import with_fixtures

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None, recursive: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, with_fixtures(sql, recursive) if sql else None, operators)
        return fn
    return deco


def r6(c: str | Column, name: str | None = None, digits: int = 6) -> Column:
    """Round a double for oracle comparison (same digits on both sides)."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), digits)
    return out.alias(name or (c if isinstance(c, str) else "value"))
