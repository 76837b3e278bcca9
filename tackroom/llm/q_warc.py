"""Query of operator 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.registry import query, table
from tackroom.llm.warc import read_archives, write_archives
from tackroom.session import scratch_dir

OP10_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op10_warc", OP10_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: all ``pages`` as WARC records, read back from the archives."""
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
