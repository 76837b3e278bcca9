"""Query of operator 12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.ann import search
from tackroom.llm.registry import query, table


@query("op12_nearest_neighbours")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: the ten nearest vectors found for every row whose vec_id is divisible by 100, among all rows."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
