"""Registered queries for shards, staging, the versioned target, snapshots,
upserts and id batches. Each writes under a fresh folder of the shared
checkpoint root (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.operators.batches import batch_of, batch_outcomes, id_batches, missing_ids
from tackroom.operators.upsert import assert_unique_source, reconcile_counts, upsert
from tackroom.plans.registry import query, table
from tackroom.session import scratch_dir
from tackroom.sources.shards import list_shards, merge_summary, read_shard_lines, write_batch_shards
from tackroom.sources.tables import (
    load_staging, read_snapshot, read_target, write_snapshot, write_target,
)

RUN_TS = "2024-06-01 00:00:00"      # fixed run timestamp, for determinism
BASE_TS = "2024-01-01 00:00:00"     # updated_at of rows already in a target
STAMP_MILLIS = 1717200000000        # RUN_TS in epoch milliseconds
MASTER_NAME = "master_horse_data_2024-06-01_00-00-00.ndjson"


@query("shard_union_summary", "S1 S2 S5 S6 U1", sql=f"""
SELECT CAST(count(DISTINCT o_orderkey // 1000) AS BIGINT) AS merged_count,
  CAST(count(*) AS BIGINT) AS line_count, '{MASTER_NAME}' AS master_file
FROM orders
""")
def shard_union_summary(spark, sf_dir):
    """``orders`` landed as NDJSON shards of 1,000 keys, then discovered by the
    shard-name pattern and unioned back in merge order."""
    root = scratch_dir(spark, "shards")
    write_batch_shards(table(spark, sf_dir, "orders"), root, "o_orderkey", 0, 1000, STAMP_MILLIS)
    files = list_shards(spark, root, layout="partitioned")
    return merge_summary(files, read_shard_lines(spark, root, layout="partitioned"), MASTER_NAME)


@query("batch_shards", "S6 U2", sql="""
SELECT CAST((c_custkey // 100) * 100 AS BIGINT) AS shard_lo, CAST((c_custkey // 100) * 100 + 99 AS BIGINT) AS shard_hi,
  CAST(count(*) AS BIGINT) AS n_lines, CAST(count(DISTINCT c_custkey) AS BIGINT) AS n_ids,
  round(sum(c_acctbal), 2) AS sum_acctbal
FROM customer GROUP BY 1, 2
""")
def batch_shards(spark, sf_dir):
    """``customer`` written as one shard per 100 keys and read back by shard."""
    root = scratch_dir(spark, "batches")
    write_batch_shards(table(spark, sf_dir, "customer"), root, "c_custkey", 0, 100, STAMP_MILLIS)
    lines = read_shard_lines(spark, root, layout="partitioned")
    rec = lines.select("shard", F.from_json("line", "c_custkey long, c_acctbal double").alias("r"))
    rng = F.regexp_extract("shard", r"_(\d+)_to_(\d+)_", 1).cast("long"), \
        F.regexp_extract("shard", r"_(\d+)_to_(\d+)_", 2).cast("long")
    return rec.groupBy(rng[0].alias("shard_lo"), rng[1].alias("shard_hi")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("r.c_custkey").alias("n_ids"),
        F.round(F.sum("r.c_acctbal"), 2).alias("sum_acctbal"))


def _customer_batches(spark, sf_dir, size=100):
    """Batches of ``size`` ids from 1 up to the largest customer key."""
    hi = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    n = max(1, -(-int(hi) // size))
    return id_batches(spark, 1, size, n)


RANGE_SQL = """
  SELECT range AS id, (range - 1) // 100 + 1 AS batch
  FROM range(1, (SELECT CAST(ceil(max(c_custkey) / 100.0) * 100 AS BIGINT) + 1 FROM customer))
"""


@query("id_batches", "U2 U3", sql=f"""
SELECT CAST(batch AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_ids,
  CAST(count(o.o_custkey) AS BIGINT) AS n_found, CAST(count(*) - count(o.o_custkey) AS BIGINT) AS n_missing
FROM ({RANGE_SQL}) r LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON r.id = o.o_custkey
GROUP BY batch
""")
def id_batches_q(spark, sf_dir):
    b = _customer_batches(spark, sf_dir)
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct() \
        .withColumn("hit", F.lit(1))
    j = b.join(found, "id", "left")
    return j.groupBy("batch").agg(F.count(F.lit(1)).alias("n_ids"), F.count("hit").alias("n_found"),
                                  (F.count(F.lit(1)) - F.count("hit")).alias("n_missing"))


@query("missing_ids", "U3", sql=f"""
SELECT CAST(batch AS BIGINT) AS batch, id FROM ({RANGE_SQL}) r
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = r.id)
""")
def missing_ids_q(spark, sf_dir):
    b = _customer_batches(spark, sf_dir)
    return missing_ids(b, table(spark, sf_dir, "orders"), "o_custkey").select("batch", "id")


@query("batch_outcomes", "A4", sql="""
SELECT CAST(o_orderkey // 1000 + 1 AS BIGINT) AS batch,
  CASE o_orderstatus WHEN 'F' THEN 'found' WHEN 'O' THEN 'not_found' ELSE 'error' END AS outcome,
  CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1, 2
""")
def batch_outcomes_q(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "found").when(F.col("o_orderstatus") == "O", "not_found") \
               .otherwise("error")
    return batch_outcomes(o, batch_of(F.col("o_orderkey"), 0, 1000), outcome)


@query("staging_roundtrip", "S8 S9", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def staging_roundtrip(spark, sf_dir):
    """``supplier`` to NDJSON, loaded back with an explicit schema, committed as
    a target version and read back through the version pointer."""
    root = scratch_dir(spark, "staging")
    table(spark, sf_dir, "supplier").write.mode("errorifexists").json(f"{root}/ndjson")
    staged = load_staging(spark, f"{root}/ndjson",
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    write_target(staged, f"{root}/target", key="s_suppkey")
    return read_target(spark, f"{root}/target").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("snapshot_by_date", "S10 F6", sql="""
SELECT '20240601' AS snapshot_date, o_orderstatus, CAST(count(*) AS BIGINT) AS n,
  round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY o_orderstatus
""")
def snapshot_by_date(spark, sf_dir):
    """Two dated snapshots of ``orders``; reading one date prunes the other."""
    root = scratch_dir(spark, "snapshots")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    day = spark.range(1).select(F.date_format(F.lit(RUN_TS).cast("timestamp"), "yyyyMMdd")).first()[0]
    write_snapshot(o, root, day)
    write_snapshot(o, root, "20240602")
    snap = read_snapshot(spark, root, day)
    return snap.groupBy("snapshot_date", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))


def _upsert_inputs(spark, sf_dir):
    """Target: orders whose key is not a multiple of 3. Source: orders whose key
    is a multiple of 3 (inserts) or of 2 (updates, price doubled). Every order
    is in the target, the source, or both."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    target = o.where(k % 3 != 0).withColumn("updated_at", F.lit(BASE_TS).cast("timestamp"))
    source = o.where((k % 3 == 0) | (k % 2 == 0)).withColumn(
        "o_totalprice", F.when(k % 3 != 0, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    return target, source


UPSERT_SQL = """
-- every order appears once: the modulus only says whether it came from the target, the source or both
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  o_orderstatus,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 THEN epoch_us(TIMESTAMP '2024-06-01 00:00:00')
       ELSE epoch_us(TIMESTAMP '2024-01-01 00:00:00') END AS updated_at_us
FROM orders
"""


def _run_upsert(spark, sf_dir):
    """Target bucketed on the key: the upsert's anti-join reads it in place and
    shuffles only the source."""
    root = scratch_dir(spark, "upsert")
    b = int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = "o_orderkey"
    target, source = _upsert_inputs(spark, sf_dir)
    write_target(target, root, key=k, buckets=b)
    before = read_target(spark, root)
    assert_unique_source(source, k)
    write_target(upsert(before, source, k, RUN_TS, buckets=b), root, key=k, buckets=b)
    return before, source, read_target(spark, root)


@query("upsert_orders", "J2 J3 S9 F13", sql=UPSERT_SQL)
def upsert_orders(spark, sf_dir):
    _, _, after = _run_upsert(spark, sf_dir)
    return after.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                        F.unix_micros("updated_at").alias("updated_at_us"))


@query("upsert_reconcile", "A3", sql="""
SELECT CAST(count_if(o_orderkey % 3 <> 0) AS BIGINT) AS rows_before,
  CAST(count_if(o_orderkey % 3 = 0 OR o_orderkey % 2 = 0) AS BIGINT) AS rows_source,
  CAST(count_if(o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0) AS BIGINT) AS rows_matched,
  CAST(count(*) AS BIGINT) AS rows_after,
  CAST(count_if(o_orderkey % 3 = 0) AS BIGINT) AS rows_inserted, TRUE AS balanced
FROM orders
""")
def upsert_reconcile(spark, sf_dir):
    before, source, after = _run_upsert(spark, sf_dir)
    return reconcile_counts(before, source, after, "o_orderkey")
