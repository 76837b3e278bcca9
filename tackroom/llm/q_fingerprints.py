"""Query of operator 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.fingerprints import neighbour_fingerprints
from tackroom.llm.registry import query, table


@query("op5_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: fingerprints of every whole text of ``documents`` and of its edited text."""
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
