"""Queries of the duplicate-removing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.near_dedup import near_groups
from tackroom.llm.registry import query, table

OP3_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1),
                             lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), uni AS (  -- documents with equal sets are one node
  SELECT md5(array_to_string(list_sort(s), '|')) AS k, min(doc_id) AS rep, any_value(len(s)) AS n
  FROM sets WHERE len(s) > 0 GROUP BY 1
), inv AS (
  SELECT i.doc_id AS d, i.n, i.x FROM items i JOIN uni u ON u.rep = i.doc_id
), links AS (
  SELECT a.d AS a, b.d AS b FROM inv a JOIN inv b ON a.x = b.x AND a.d < b.d
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.d, b.d, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  WITH RECURSIVE r(a, b) AS (
    SELECT rep, rep FROM uni
    UNION
    SELECT r.a, e.b FROM r JOIN both_ways e ON e.a = r.b
  ) SELECT a, min(b) AS c FROM r GROUP BY a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(coalesce(r.c, s.doc_id) AS BIGINT) AS component_id,
       s.doc_id = coalesce(r.c, s.doc_id) AS kept
FROM sets s
LEFT JOIN uni u ON len(s.s) > 0 AND u.k = md5(array_to_string(list_sort(s.s), '|'))
LEFT JOIN reach r ON r.a = u.rep
"""


@query("op3_near_dedup", OP3_SQL)
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over whole ``documents``: 3-word shingles, similarity 0.85, full-set confirmation."""
    return near_groups(table(spark, sf_dir, "documents"), shingle=3, similarity=(85, 100))
