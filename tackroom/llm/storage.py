"""Cutting lineage: tables written once to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tackroom.session import scratch_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    The files are on shared storage, so a lost executor costs only its own
    running tasks, and the reader plans with the true size of the table: Spark
    broadcasts it only if the files are below its threshold.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
