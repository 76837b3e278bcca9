"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.langid import identify
from tackroom.llm.registry import query, table


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: the language of every whole text of ``documents``."""
    return identify(table(spark, sf_dir, "documents"))
