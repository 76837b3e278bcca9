"""Registry of this subpackage's queries: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = Query(fn, sql)
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
