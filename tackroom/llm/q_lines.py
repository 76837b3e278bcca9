"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.line_dedup import removals
from tackroom.llm.registry import query, table

OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(v, 1) - 1 AS line, unnest(v) AS value
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS v FROM documents)
), t AS (
  SELECT doc_id, line, list_sort(list_distinct(list_filter(string_split_regex(value, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s FROM l
), g AS (
  SELECT s, min((doc_id, line)) AS f, len(s) AS n FROM t WHERE len(s) > 0 GROUP BY s
), r AS (
  SELECT row_number() OVER (ORDER BY f) AS rid, s, f, n FROM g
), x AS (
  SELECT rid, n, unnest(s) AS w FROM r
), near AS (
  SELECT DISTINCT a.rid FROM (
    SELECT a.rid, b.rid AS e, a.n, b.n AS m, count(*) AS c FROM x a JOIN x b ON a.w = b.w AND b.rid < a.rid
       AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    GROUP BY ALL) a WHERE 5 * c >= 4 * (n + m - c)
), gone AS (
  SELECT t.doc_id, t.line FROM t JOIN r ON t.s = r.s
  WHERE (t.doc_id, t.line) <> r.f OR r.rid IN (SELECT rid FROM near)
), per AS (
  SELECT doc_id, count(*) AS c, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed FROM gone GROUP BY 1
)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(c, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN per USING (doc_id)
"""


@query("op9_line_dedup", OP9_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all lines of ``documents``: word-set Jaccard of 0.8 or more with an earlier line."""
    return removals(table(spark, sf_dir, "documents"))
