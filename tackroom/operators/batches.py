"""Id batches, missing ids and per-batch outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_of(id_col: Column, start: int, size: int) -> Column:
    """1-based batch number of an id: batch b covers start+(b-1)*size .. start+b*size-1."""
    return (F.floor((id_col - F.lit(start)) / F.lit(size)) + 1).cast("long")


def id_batches(spark: SparkSession, start: int, size: int, n: int) -> DataFrame:
    """Every id of ``n`` batches with its batch number; ``spark.range`` is
    generated in parallel on executors, nothing is materialised on the driver."""
    if start <= 0 or size <= 0:
        raise ValueError("start and size must be positive")
    return spark.range(start, start + size * n, numPartitions=None) \
                .select(F.col("id"), batch_of(F.col("id"), start, size).alias("batch"))


def missing_ids(batches: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Ids in the requested range that yielded no record (anti-join)."""
    found = records.select(F.col(key).alias("id")).where(F.col("id").isNotNull())
    return batches.join(found, "id", "left_anti")


def batch_outcomes(df: DataFrame, batch: Column, outcome: Column) -> DataFrame:
    """A4: count of ids per (batch, outcome) — found / not_found / error."""
    return df.groupBy(batch.alias("batch"), outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
