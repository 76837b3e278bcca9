"""Query of operator 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.decontaminate import contamination
from tackroom.llm.registry import query, table

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, w, least(13, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
), iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM i)
), dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i))
), hit AS (
  SELECT DISTINCT dw.doc_id, dw.n, dw.p, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1
), named AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op1_decontamination", OP1_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: whole ``documents`` against whole ``benchmark``, windows of 13 words."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
