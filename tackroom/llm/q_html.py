"""Query of operator 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.html_extract import extract
from tackroom.llm.registry import query, table


@query("op6_html_extract")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: the main text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages"))
