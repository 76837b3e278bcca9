"""Query of operator 11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.fim import fill_in_middle, restore
from tackroom.llm.registry import query, table

SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
        CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN doc_id IS NULL OR n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
             THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, form, a, b, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: every whole text of ``documents`` cut and laid out, and rebuilt from the output and its form."""
    laid = fill_in_middle(table(spark, sf_dir, "documents"))
    known = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    back = restore(laid.select(*known, F.sha2("output", 256).alias("output_sha256"), "output"), text_col="restored")
    return back.select(*known, "output_sha256", F.sha2("restored", 256).alias("restored_sha256"))
