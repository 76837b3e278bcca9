"""Query of operator 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.registry import query, table
from tackroom.llm.sharding import SHARDS, SLOTS, assign

_N = len(SHARDS)
OP7_SQL = f"""
WITH RECURSIVE shard AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({_N}) t(i)
), preference AS (
  SELECT list(CAST(('0x' || md5('offset:' || name)[1:13]) AS BIGINT) % {SLOTS} ORDER BY i) AS off,
         list(CAST(('0x' || md5('skip:' || name)[1:13]) AS BIGINT) % {SLOTS - 1} + 1 ORDER BY i) AS skip,
         list(name ORDER BY i) AS names FROM shard
), fill(turn, tab, step) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1), list_transform(range({_N}), lambda x: 0)
  UNION ALL
  SELECT turn + 1,
         list_transform(tab, lambda v, q: CASE WHEN q - 1 = (off[turn % {_N} + 1] + j * skip[turn % {_N} + 1]) % {SLOTS}
                                               THEN turn % {_N} ELSE v END),
         list_transform(step, lambda v, q: CASE WHEN q - 1 = turn % {_N} THEN j + 1 ELSE v END)
  FROM (SELECT *, (SELECT min(s) FROM range({SLOTS}) r(s) WHERE s >= step[turn % {_N} + 1]
                   AND tab[(off[turn % {_N} + 1] + s * skip[turn % {_N} + 1]) % {SLOTS} + 1] = -1) AS j
        FROM fill, preference WHERE turn < {SLOTS})
), ready AS (
  SELECT tab FROM fill WHERE turn = {SLOTS}
), d AS (
  SELECT doc_id, text, CAST(('0x' || md5(CAST(doc_id AS VARCHAR))[1:13]) AS BIGINT) % {SLOTS} AS slot FROM documents
)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, names[tab[slot + 1] + 1] AS shard,
       CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes
FROM d, ready, preference
"""


@query("op7_sharding", OP7_SQL)
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: the shard of every document, with the bytes that it brings there."""
    placed = assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "slot", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
