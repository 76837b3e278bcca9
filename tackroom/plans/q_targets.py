"""Registered queries of the merge-on-read target, the quarantine and the ledger of consumed shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.operators.quarantine import read_quarantine
from tackroom.plans.flows import merge_clean_upsert
from tackroom.plans.q_io import BASE_TS, RUN_TS, STAMP_MILLIS
from tackroom.plans.registry import query, table
from tackroom.session import scratch_dir
from tackroom.sources import merge_on_read as mor
from tackroom.sources.ledger import read_ledger
from tackroom.sources.shards import write_batch_shards, write_line_shards
from tackroom.streaming.incremental import incremental_shards, shard_stream

SECOND_TS, THIRD_TS = "2024-06-02 00:00:00", "2024-06-03 00:00:00"


def _history(spark, sf_dir, compact_last: bool):
    """A base of the orders whose key is no multiple of 3, then three runs: all multiples of 3 (inserts), the even keys with
    their price doubled, a compaction, and the multiples of 5 with their status in lower case. Every order is in it."""
    root, key = scratch_dir(spark, "merge-on-read"), "o_orderkey"
    o = table(spark, sf_dir, "orders").select(key, "o_custkey", "o_totalprice", "o_orderstatus")
    k = F.col(key)
    doubled = F.when(k % 2 == 0, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    mor.upsert_delta(o.where(k % 3 != 0), root, key, BASE_TS, txn="base", files=8)
    mor.upsert_delta(o.where(k % 3 == 0), root, key, RUN_TS, txn="inserts")
    mor.upsert_delta(o.where(k % 2 == 0).withColumn("o_totalprice", doubled), root, key, SECOND_TS, txn="prices")
    mor.compact(spark, root, key, files=8)
    last = o.where(k % 5 == 0).withColumn("o_totalprice", doubled).withColumn("o_orderstatus", F.lower("o_orderstatus"))
    mor.upsert_delta(last, root, key, THIRD_TS, txn="status")
    mor.upsert_delta(last, root, key, "2024-06-09 00:00:00", txn="status")  # a replay: already there
    if compact_last:
        mor.compact(spark, root, key, files=8)
    return root, key


MERGED_SQL = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN epoch_us(TIMESTAMP '2024-06-03 00:00:00')
       WHEN o_orderkey % 2 = 0 THEN epoch_us(TIMESTAMP '2024-06-02 00:00:00')
       WHEN o_orderkey % 3 = 0 THEN epoch_us(TIMESTAMP '2024-06-01 00:00:00')
       ELSE epoch_us(TIMESTAMP '2024-01-01 00:00:00') END AS updated_at_us
FROM orders
"""


@query("merge_on_read_orders", "J2 J3 S9 F13", sql=MERGED_SQL)
def merge_on_read_orders(spark, sf_dir):
    """The merged table over a base, a compaction and a delta that is not compacted yet."""
    root, key = _history(spark, sf_dir, compact_last=False)
    return mor.read_merged(spark, root, key).select(
        key, "o_custkey", "o_totalprice", "o_orderstatus", F.unix_micros("updated_at").alias("updated_at_us"))


@query("merge_on_read_counts", "A3 J2", sql="""
WITH c AS (SELECT count_if(o_orderkey % 3 <> 0) AS base, count_if(o_orderkey % 3 = 0) AS added, count_if(o_orderkey % 2 = 0) AS priced,
  count_if(o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0) AS priced_base, count(*) AS n, count_if(o_orderkey % 5 = 0) AS last FROM orders)
SELECT CAST(0 AS BIGINT) AS commit, 'upsert' AS op, CAST(base AS BIGINT) AS rows_source, CAST(0 AS BIGINT) AS rows_before,
  CAST(0 AS BIGINT) AS rows_replaced, CAST(base AS BIGINT) AS rows_inserted, CAST(base AS BIGINT) AS rows_after, TRUE AS balanced FROM c
UNION ALL SELECT 3, 'compact', CAST(added + priced AS BIGINT), CAST(base AS BIGINT), CAST(priced_base AS BIGINT), CAST(added AS BIGINT), n, TRUE FROM c
UNION ALL SELECT 5, 'compact', CAST(last AS BIGINT), n, CAST(last AS BIGINT), 0, n, TRUE FROM c
""")
def merge_on_read_counts(spark, sf_dir):
    """What every commit that folds rows into the base counted while it wrote: nothing of the target is read for it."""
    root, _ = _history(spark, sf_dir, compact_last=True)
    return mor.reconcile_log(spark, root)


@query("merge_on_read_range", "S9", sql=f"""
SELECT o_orderkey, o_totalprice, TRUE AS skipped_files
FROM ({MERGED_SQL}) WHERE o_orderkey BETWEEN (SELECT max(o_orderkey) // 2 FROM orders) AND (SELECT max(o_orderkey) // 2 + 1000 FROM orders)
""")
def merge_on_read_range(spark, sf_dir):
    """The rows of a thousand keys in the middle, from the files whose smallest and largest key let them hold one."""
    root, key = _history(spark, sf_dir, compact_last=True)
    lo = table(spark, sf_dir, "orders").agg(F.max(key)).first()[0] // 2
    opened, live = mor.files_read(spark, root, lo, lo + 1000)
    return mor.read_merged(spark, root, key, lo, lo + 1000).select(key, "o_totalprice", F.lit(opened < live).alias("skipped_files"))


def _defect_lines(spark, sf_dir):
    """``events`` as lines, with defects by ``event_id % 20``: blank, tab-only, trailing text, no id, a fraction where the
    schema has a whole number, an object where it has a text, and text inside a nested number."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    r, i = F.col("event_id") % 20, F.col("event_id").cast("string")
    rec = lambda user, kind, depth: F.concat(F.lit('{"id":'), i, F.lit(',"user":'), user, F.lit(',"type":'), kind,
                                             F.lit(',"at":{"depth":'), depth, F.lit("}}"))
    user, kind, depth = F.col("user_id").cast("string"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.lit("1e0")
    line = (F.when(r == 3, F.lit("  ")).when(r == 4, F.lit("\t"))
            .when(r == 7, F.concat(rec(user, kind, depth), F.lit(" trailing")))
            .when(r == 11, F.lit('{"user":1}'))
            .when(r == 13, rec(F.concat(user, F.lit(".5")), kind, depth))
            .when(r == 15, rec(user, F.lit('{"no":"text"}'), F.lit('"deep"')))
            .otherwise(rec(F.concat(user, F.lit(".0")), kind, depth)))
    return e.select("event_id", line.alias("line"))


@query("quarantine_by_class", "E2 P2 P3 S8", sql="""
SELECT class, field, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT line) AS BIGINT) AS n_lines FROM (
  SELECT 'malformed' AS class, NULL AS field, event_id AS line FROM events WHERE event_id % 20 = 7
  UNION ALL SELECT 'missing_id', NULL, 0 FROM events WHERE event_id % 20 = 11
  UNION ALL SELECT 'missing_id', NULL, -1 FROM events WHERE event_id = 0  -- an id of 0 is falsy
  UNION ALL SELECT 'misfit', 'user', event_id FROM events WHERE event_id % 20 = 13
  UNION ALL SELECT 'misfit', unnest(['type', 'at.depth']), event_id FROM events WHERE event_id % 20 = 15
  UNION ALL SELECT 'loaded', NULL, event_id FROM events WHERE event_id % 20 NOT IN (3, 4, 7, 11, 13, 15) AND event_id <> 0)
GROUP BY class, field
""")
def quarantine_by_class(spark, sf_dir):
    """Lines landed as shards and ingested into a merge-on-read target with a quarantine: what was held back by class and field, nested
    ones too, and what was loaded. No line stops the job."""
    root, target, held = (scratch_dir(spark, n) for n in ("held-src", "held-target", "held"))
    write_line_shards(_defect_lines(spark, sf_dir), root, "event_id", 0, 1000, STAMP_MILLIS)
    merge_clean_upsert(spark, root, target, "id long, user long, type string, at struct<depth:int>", "id", RUN_TS,
                       layout="partitioned", quarantine=held, merge_on_read=True)
    q = read_quarantine(spark, held).select("class", "field", "line")
    loaded = mor.read_merged(spark, target, "id").select(F.lit("loaded").alias("class"), F.lit(None).cast("string").alias("field"),
                                                         F.col("id").cast("string").alias("line"))
    return q.unionByName(loaded).groupBy("class", "field").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("line").alias("n_lines"))


@query("shared_ledger", "T1 S4", sql="""
SELECT consumer, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(n) AS BIGINT) AS n_lines FROM (
  SELECT CASE WHEN event_id // 1000 % 2 = 0 THEN 'batch' ELSE 'stream' END AS consumer, event_id // 1000 AS shard, count(*) AS n
  FROM events GROUP BY 1, 2) GROUP BY consumer
""")
def shared_ledger(spark, sf_dir):
    """``events`` landed as shards of 1,000 ids in two landings. A batch run takes the first, a stream over the same folder
    then takes only the second, and another batch run finds nothing left: every shard is consumed once."""
    root, ledger, sink = (scratch_dir(spark, n) for n in ("ledger-src", "ledger", "ledger-sink"))
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    even = F.floor(F.col("event_id") / 1000) % 2 == 0
    target = scratch_dir(spark, "ledger-target")
    schema, opts = "event_id long, event_type string, value double", {"layout": "partitioned", "ledger": ledger, "merge_on_read": True}
    for part, batch in ((even, True), (~even, False)):
        write_batch_shards(ev.where(part).withColumn("id", F.col("event_id") + 1), root, "event_id", 0, 1000, STAMP_MILLIS)
        if batch:
            merge_clean_upsert(spark, root, target, "id long, " + schema, "id", RUN_TS, **opts)
    incremental_shards(shard_stream(spark, root, layout="partitioned"), sink, scratch_dir(spark, "ledger-ckpt"), ledger, root, "partitioned")
    merge_clean_upsert(spark, root, target, "id long, " + schema, "id", SECOND_TS, **opts)  # nothing is left
    files = read_ledger(spark, ledger).groupBy("consumer").agg(F.count(F.lit(1)).alias("n_files"))
    lines = mor.read_merged(spark, target, "id").select(F.lit("batch").alias("consumer")) \
        .unionAll(spark.read.schema("line string").parquet(sink).select(F.lit("stream").alias("consumer"))).groupBy("consumer").agg(F.count(F.lit(1)).alias("n_lines"))
    return files.join(lines, "consumer").select("consumer", "n_files", "n_lines")
