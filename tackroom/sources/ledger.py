"""One ledger of consumed shard files for batch and streaming runs.

A row says which run consumed a file. Every run, of either kind, leaves out the
files that are in it and adds its own after its data is committed, so that a
shard is consumed once, whoever meets it first. Empty shards have no lines, so
they are added from the listing. Rows are partitioned by run: a repeated run
replaces its own rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SCHEMA = "file_path string, consumer string, run string"


def file_key(path: Column) -> Column:
    """A local file's path spelled one way: batch and streaming readers write ``file:/a`` and ``file:///a``."""
    return F.when(path.startswith("file:"), F.regexp_replace(path, "^file:/+", "file:/")).otherwise(path)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """(file_path, consumer, run) of every consumed file; None before the first run."""
    try:
        return spark.read.schema(SCHEMA).parquet(ledger)
    except AnalysisException:
        return None


def consume(files: DataFrame, ledger: str, consumer: str = "batch", run: str | None = None) -> None:
    """Add the files of ``files`` (``file_path``) as consumed by one run; only after what was made of them is committed."""
    (files.select(file_key(F.col("file_path")).alias("file_path")).distinct().withColumn("consumer", F.lit(consumer)).withColumn("run", F.lit(run or uuid.uuid4().hex))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(ledger))


def not_consumed(rows: DataFrame, ledger: str, run: str | None = None) -> DataFrame:
    """Rows (with ``file_path``) of files that no run but ``run`` itself has consumed."""
    done = read_ledger(rows.sparkSession, ledger)
    if done is None:
        return rows
    if run is not None:
        done = done.where(F.col("run") != run)
    return among(rows, done, "left_anti")


def among(rows: DataFrame, files: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``file_path`` is one of ``files`` (or, with left_anti, none of them)."""
    named = files.select(file_key(F.col("file_path")).alias("_file")).distinct()
    return rows.join(named, file_key(rows["file_path"]) == F.col("_file"), how).select(*rows.columns)
