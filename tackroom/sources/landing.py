"""Landings with a manifest (S1, S2, S6): shards as files of one folder a landing, and what is in each.

``write_batch_shards`` makes a folder for every batch of ids, which at many batches
is a listing of as many folders. A landing is one folder of NDJSON files, one or
more a batch (each under its number), and one small Parquet table beside it that names each file with its
shard, line count and smallest and largest id. It is written after the lines, so a
landing that failed is not there for readers. Readers list nothing: they take the
files from the manifest, and leave out those that cannot hold the ids asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tackroom.constants import SHARD_NAME_PATTERN, SHARD_PREFIX
from tackroom.sources.ledger import among, file_key
from tackroom.sources.shards import LINE_SCHEMA, ORDER_COLS, shard_of

FILES_A_TASK = 64
MANIFEST = "shard string, file string, n_lines long, min_id long, max_id long, landing string"


def land(rows: DataFrame, root: str, key: str, start: int, size: int, stamp_millis: int, landing: str,
         line_col: str | None = None, prefix: str = SHARD_PREFIX, max_lines: int = 1_000_000) -> None:
    """Write ``rows`` as the landing ``landing``: JSON lines (nulls are written), or the text of ``line_col`` as it is.

    A batch of ``size`` ids from ``start`` on is a shard; one of more than ``max_lines``
    rows is dealt over several files by a hash of the row, so a batch in which one id
    has most rows is no single task. Lines of a file are in the order of their ids. An
    id that is NULL or below ``start`` fails the landing; one that is there already is replaced.
    """
    spark, base = rows.sparkSession, f"{root.rstrip('/')}/landing={landing}"
    line = F.col(line_col) if line_col else F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    tagged = rows.select(shard_of(key, start, size, stamp_millis, prefix).alias("shard"), F.col(key).cast("long").alias("id"), line.alias("line"))
    # one row a shard: its number of files, and the number of its first
    files = F.ceil(F.col("n") / max_lines)
    shards = tagged.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo")).withColumn("files", files) \
        .withColumn("first", F.sum("files").over(Window.orderBy("lo", "shard").rowsBetween(Window.unboundedPreceding, -1)))
    shards = spark.createDataFrame(shards.select("shard", "files", F.coalesce("first", F.lit(0)).alias("first"), "n").collect(),
                                   "shard string, files long, first long, n long")
    total, most = shards.agg(F.coalesce(F.sum("files"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    dealt = tagged.join(shards, "shard").withColumn(
        "file", (F.col("first") + F.pmod(F.xxhash64("id", "line"), F.col("files"))).cast("int"))
    # a task writes several files one after the other, as starting one takes longer than writing a small file
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(total, max(width, -(-total // FILES_A_TASK), -(-most // max_lines))))
    (dealt.drop("n").repartitionById(tasks, F.pmod(F.col("file"), F.lit(tasks)).cast("int")).sortWithinPartitions("file", "id")
     .select("file", "line").write.mode("overwrite").partitionBy("file").text(base))
    # the n-th file is in the folder of its number; its shard is the one that numbers were given to
    stored = spark.read.schema("value string, file long").text(base).groupBy("file", F.col("_metadata.file_name").alias("part")).agg(F.count(F.lit(1)).alias("n_lines"))
    name = F.concat(F.lit("file="), F.col("number").cast("string"), F.lit("/"), F.col("part"))
    ids = dealt.groupBy(F.col("file").alias("number")).agg(
        F.first("shard").alias("shard"), F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    listed = stored.withColumnRenamed("file", "number").join(ids, "number").withColumn("name", name)
    wrong = F.raise_error(F.concat(F.lit("lines were lost or repeated in "), F.col("name"))).cast("long")
    (listed.select("shard", F.concat(F.lit(f"landing={landing}/"), F.col("name")).alias("file"),
                   F.when(F.col("n") == F.col("n_lines"), F.col("n")).otherwise(wrong).alias("n_lines"), "min_id", "max_id")
     .coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/_manifest/landing={landing}"))


def landed_files(spark: SparkSession, root: str, lo: int | None = None, hi: int | None = None,
                 pattern: str = SHARD_NAME_PATTERN) -> DataFrame:
    """The manifests' rows of all landings under ``root``, of files that can hold an id from ``lo`` to ``hi``."""
    try:
        files = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/_manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)
    files = files.where(F.col("shard").rlike(pattern))
    if lo is not None:
        files = files.where(F.col("max_id") >= lo)
    return files if hi is None else files.where(F.col("min_id") <= hi)


def read_landed(spark: SparkSession, root: str, lo: int | None = None, hi: int | None = None,
                pattern: str = SHARD_NAME_PATTERN, consumed: DataFrame | None = None) -> DataFrame:
    """Lines with their order key, as ``read_shard_lines`` gives them, from the files of ``landed_files``; no folder is listed."""
    files = landed_files(spark, root, lo, hi, pattern).select(
        F.concat(F.lit(f"{root.rstrip('/')}/"), F.col("file")).alias("path"), "shard").collect()  # one row a file
    if not files:
        return spark.createDataFrame([], LINE_SCHEMA)
    # a file is known by its folder and name: all files that one task wrote have the same name
    shards = spark.createDataFrame([("/".join(f["path"].rsplit("/", 2)[1:]), f["shard"]) for f in files], "_place string, shard string")
    raw = spark.read.text([f["path"] for f in files]).select(
        F.substring_index(F.col("_metadata.file_path"), "/", -2).alias("_place"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("row_id"), F.col("value").alias("line"))
    lines = raw.join(shards, "_place").select(*ORDER_COLS, "line", "file_name")
    return lines if consumed is None else among(lines, consumed, "left_anti")


def list_landed(spark: SparkSession, root: str, pattern: str = SHARD_NAME_PATTERN, consumed: DataFrame | None = None) -> DataFrame:
    """The landed files as ``list_shards`` gives them (length in lines)."""
    path = F.concat(F.lit(f"{root.rstrip('/')}/"), F.col("file"))
    files = landed_files(spark, root, pattern=pattern).select(
        "shard", F.when(path.startswith("/"), F.concat(F.lit("file:"), path)).otherwise(file_key(path)).alias("file_path"),
        F.element_at(F.split("file", "/"), -1).alias("file_name"), F.col("n_lines").alias("length"))
    return files if consumed is None else among(files, consumed, "left_anti")
