"""Registered queries of landings with a manifest, flat shard files and inferred schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.functions.inference import infer_types, load_inferred
from tackroom.operators.clean import clean, kept_lines
from tackroom.operators.skew import rank_in_group
from tackroom.plans.flows import clean_job, merge_job
from tackroom.plans.q_clean import RANKED_EVENTS_SQL, event_lines
from tackroom.plans.q_io import STAMP_MILLIS
from tackroom.plans.registry import query, table
from tackroom.session import scratch_dir
from tackroom.sources.landing import land, landed_files, read_landed
from tackroom.sources.ledger import read_ledger
from tackroom.sources.shards import ORDER_COLS, cleaned_name, list_shards, read_shard_lines, write_batch_shards, write_master
from tackroom.sources.tables import _fs


def _landed(spark, sf_dir, size):
    """``orders`` as shards of ``size`` keys in two landings, the odd and the even ones."""
    root, o = scratch_dir(spark, "landed"), table(spark, sf_dir, "orders")
    odd = F.floor(F.col("o_orderkey") / size) % 2 == 1
    land(o.where(odd), root, "o_orderkey", 0, size, STAMP_MILLIS, "first")
    land(o.where(~odd), root, "o_orderkey", 0, size, STAMP_MILLIS + 1, "second")
    return root


@query("landed_shards", "S1 S2 S6 U1", sql="""
SELECT CAST(o_orderkey // 1000 * 1000 AS BIGINT) AS shard_lo, CASE WHEN o_orderkey // 1000 % 2 = 1 THEN 'first' ELSE 'second' END AS landing,
  CAST(min(o_orderkey) AS BIGINT) AS min_id, CAST(max(o_orderkey) AS BIGINT) AS max_id, CAST(count(*) AS BIGINT) AS n_lines,
  round(sum(o_totalprice), 2) AS total_price FROM orders GROUP BY 1, 2
""")
def landed_shards(spark, sf_dir):
    """What the manifest says of each shard, beside the sum over its lines as they are read back."""
    root = _landed(spark, sf_dir, 1000)
    lo = F.regexp_extract("shard", r"_(\d+)_to_", 1).cast("long").alias("shard_lo")
    told = landed_files(spark, root).groupBy(lo, "landing").agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"),
                                                                F.sum("n_lines").alias("n_lines"))
    read = read_landed(spark, root).select(lo, F.from_json("line", "o_totalprice double")["o_totalprice"].alias("price")) \
        .groupBy("shard_lo").agg(F.round(F.sum("price"), 2).alias("total_price"))
    return told.join(read, "shard_lo").select("shard_lo", "landing", "min_id", "max_id", "n_lines", "total_price")


@query("landed_range", "S6 S9", sql="""
SELECT o_orderkey, o_totalprice, TRUE AS skipped_files FROM orders
WHERE o_orderkey BETWEEN (SELECT max(o_orderkey) // 2 FROM orders) AND (SELECT max(o_orderkey) // 2 + 100 FROM orders)
""")
def landed_range(spark, sf_dir):
    """The lines of 101 ids in the middle, from the files that can hold them; the others are not opened."""
    root = _landed(spark, sf_dir, 500)
    lo = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] // 2
    lines = read_landed(spark, root, lo, lo + 100)
    fewer = len(lines.inputFiles()) < landed_files(spark, root).count()
    rec = lines.select(F.from_json("line", "o_orderkey long, o_totalprice double").alias("r")).select("r.*")
    return rec.where(F.col("o_orderkey").between(lo, lo + 100)).withColumn("skipped_files", F.lit(fewer))


FLAT = ["1_to_10", "1001_to_2000", "20_to_30", "3_to_9", "100_to_200", "9_to_9", "50_to_60"]   # not in the order of their names
_REFUSED = ["horse_data_a_to_b_1.ndjson", "horse_data_0_to_0_1.txt", "master_horse_data_1_to_2_1.ndjson"]


def _flat_files(spark, sf_dir):
    """``events`` as flat shard files, by ``event_id % 7``, and the last of them again under names that are no shard's. Spark
    writes one file for each, which is then given its name."""
    work, root = scratch_dir(spark, "flat-parts"), scratch_dir(spark, "flat")
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("user_id").alias("id"), "event_id"))
    names = [f"horse_data_{n}_{STAMP_MILLIS}.ndjson" for n in FLAT]
    part = F.get(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 7).cast("int"))
    again = F.explode(F.array(*[F.lit(n) for n in _REFUSED]))
    rows = e.select(part.alias("name"), "event_id", line.alias("line")).unionByName(
        e.where(F.col("event_id") % 7 == 6).select(again.alias("name"), "event_id", line.alias("line")))
    (rows.repartition("name").sortWithinPartitions("name", "event_id").select("name", "line")
     .write.partitionBy("name").text(work))
    fs, p = _fs(spark, root)
    fs.mkdirs(p)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in [*names, *_REFUSED]:
        found = fs.globStatus(hadoop(f"{work}/name={name}/part-*"))
        if found:
            fs.rename(found[0].getPath(), hadoop(f"{root}/{name}"))
    return root


@query("flat_merge_order", "S1 S2 S3 W3 F5 A1", sql=f"""
SELECT id, event_id, first_line FROM (
  SELECT user_id AS id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY name, event_id) AS rn,
    CAST(row_number() OVER (ORDER BY name, event_id) - 1 AS BIGINT) AS first_line
  FROM (SELECT *, CASE event_id % 7 {" ".join(f"WHEN {i} THEN '{n}_'" for i, n in enumerate(FLAT))} END AS name FROM events))
WHERE rn = 1 AND id <> 0  -- an id of 0 is falsy
""")
def flat_merge_order(spark, sf_dir):
    """Flat shard files merged into one master, whose lines are numbered as they stand in it, and cleaned: the record that wins
    and its line change if files are taken in another order, or a file whose name is no shard's is read."""
    root, master = _flat_files(spark, sf_dir), scratch_dir(spark, "flat-master")
    lines = read_shard_lines(spark, root)
    write_master(lines, master)
    files = spark.read.text(master).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"),
                                           F.monotonically_increasing_id().alias("row_id"), F.col("value").alias("line"))
    # the master's files in the order of their names, their lines in order: numbered by what lies before
    keyed = files.withColumn("shard", F.lit("master")).withColumn("file_name", F.lit("master"))
    kept = kept_lines(clean(keyed, ORDER_COLS)).select(*ORDER_COLS, F.from_json("line", "id long, event_id long").alias("r"))
    stored = scratch_dir(spark, "flat-numbered")
    keyed.select(*ORDER_COLS).write.parquet(stored)
    numbered = rank_in_group(spark.read.parquet(stored), ["shard"], ["file_path", "block_start", "row_id"], "first_line")
    return kept.join(numbered, ORDER_COLS).select("r.id", "r.event_id", F.col("first_line").cast("long").alias("first_line"))


def _mixed_lines(spark, sf_dir):
    """``events`` as lines whose fields change type from line to line, with blank and tab-only lines between them."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    i, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    mixed = F.when(F.col("event_id") % 11 == 5, F.concat(F.lit('"u'), user, F.lit('"'))).otherwise(user)
    rate = F.when(F.col("event_id") % 3 == 0, F.lit("1")).otherwise(F.lit("2.5"))
    flag = F.when(F.col("event_id") % 2 == 0, F.lit("true")).otherwise(F.lit("null"))
    line = F.concat(F.lit('{"id":'), i, F.lit(',"who":'), mixed, F.lit(',"rate":'), rate, F.lit(',"flag":'), flag, F.lit("}"))
    blank = F.when(F.col("event_id") % 2 == 0, F.lit("\t")).otherwise(F.lit(" "))
    return e.select(F.explode(F.array(line, blank)).alias("line"))


@query("inferred_types", "S8", sql="""
SELECT * FROM (VALUES ('flag', 'boolean', 'boolean, null', FALSE), ('id', 'bigint', 'whole', FALSE),
  ('rate', 'double', 'number, whole', TRUE), ('who', 'string', 'text, whole', TRUE)) t(field, type, seen, changed)
JOIN (SELECT CAST(count(*) AS BIGINT) AS n_lines FROM events) ON TRUE
""")
def inferred_types(spark, sf_dir):
    """The type that each field of the mixed lines is given, the kinds of values it has, and whether these differ."""
    path = scratch_dir(spark, "mixed")
    _mixed_lines(spark, sf_dir).write.text(path)
    return infer_types(spark.read.text(path), "value")


@query("inferred_load", "S8", sql="""
SELECT event_id AS id, CASE WHEN event_id % 11 = 5 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS who,
  CAST(CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 2.5 END AS DOUBLE) AS rate, CASE WHEN event_id % 2 = 0 THEN TRUE END AS flag FROM events
""")
def inferred_load(spark, sf_dir):
    """The mixed lines loaded with the types found: a number keeps its digits where others are text, and no value is lost."""
    path = scratch_dir(spark, "mixed")
    _mixed_lines(spark, sf_dir).write.text(path)
    return load_inferred(spark.read.text(path), "value").select("id", "who", "rate", "flag")


@query("cleaned_text", "E1 S3 S7 F2", sql=f"""
SELECT line, CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS place FROM ({RANKED_EVENTS_SQL}) WHERE rn = 1
""")
def cleaned_text(spark, sf_dir):
    """The cleaned file of the clean job as it is read back: its lines, byte for byte, and their places in it."""
    lines = event_lines(spark, sf_dir).select(F.lit("m").alias("shard"), F.lit("m").alias("file_path"), F.col("line_no").alias("block_start"),
                                              F.lit(0).cast("long").alias("row_id"), "line")
    out = cleaned_name(f"{scratch_dir(spark, 'cleaned')}/master.ndjson", "2024-06-01T00:00:00.000Z")
    clean_job(lines, out)
    stored = spark.read.text(out).select(F.lit("m").alias("shard"), F.col("_metadata.file_path").alias("file_path"),
                                         F.col("_metadata.file_block_start").alias("block_start"),
                                         F.monotonically_increasing_id().alias("row_id"), F.col("value").alias("line"))
    path = scratch_dir(spark, "cleaned-numbered")
    stored.write.parquet(path)
    return rank_in_group(spark.read.parquet(path), ["shard"], ["file_path", "block_start", "row_id"], "place") \
        .select("line", F.col("place").cast("long").alias("place"))


@query("merge_and_retire", "S3 S4 S5", sql="""
SELECT CAST(count(DISTINCT event_id // 1000) AS BIGINT) AS merged_count, CAST(count(*) AS BIGINT) AS line_count,
  CAST(count(DISTINCT event_id // 1000) AS BIGINT) AS in_ledger, CAST(0 AS BIGINT) AS files_left, 'nothing_to_merge' AS second_run
FROM events
""")
def merge_and_retire(spark, sf_dir):
    """``events`` landed as shards, merged and removed: what was merged, the ledger's files, the files that are left, and what a second
    run finds."""
    root, out, ledger = (scratch_dir(spark, n) for n in ("retire-src", "retire-out", "retire-ledger"))
    write_batch_shards(table(spark, sf_dir, "events").select("event_id", "event_type"), root, "event_id", 0, 1000, STAMP_MILLIS)
    first = merge_job(spark, root, out, "master-1", layout="partitioned", ledger=ledger, remove_merged=True)
    second = merge_job(spark, root, out, "master-2", layout="partitioned", ledger=ledger)
    left, noted = list_shards(spark, root, layout="partitioned").count(), read_ledger(spark, ledger).count()
    return first.select("merged_count", "line_count", F.lit(noted).cast("long").alias("in_ledger"), F.lit(left).cast("long").alias("files_left"),
                        F.lit(second.first()["status"]).alias("second_run"))
