"""Registry of named queries: a Spark builder plus, where SQL can express it,
an equivalent DuckDB oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. ``spread=True`` for inputs of CPU-heavy row work; see
    :func:`tackroom.session.ensure_parallel`."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        from tackroom.session import ensure_parallel
        df = ensure_parallel(df)
    return df
