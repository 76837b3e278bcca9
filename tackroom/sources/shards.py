"""NDJSON shards: discovery, ordered line reading, union, batch writing.

Two layouts are read:

* ``files``: flat files named like ``horse_data_1_to_1000_<millis>.ndjson``.
  ``pathGlobFilter`` prunes the listing; the exact name regex then runs on
  ``_metadata.file_name``.
* ``partitioned``: what :func:`write_batch_shards` writes, one
  ``shard=<name>`` folder per batch. The regex becomes a partition filter, so
  Spark skips non-matching folders without opening them.

Every line gets an order key ``(shard, file_path, block_start, row)``: files sort by
name (binary, so ``1001_to`` sorts before ``1_to``), splits of one file by
their byte offset, and rows of one split by ``monotonically_increasing_id``,
which counts up within a task. Together that is the (file, line) order of a
serial reader, without ever numbering lines globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tackroom.constants import CLEANED_SUFFIX, SHARD_NAME_GLOB, SHARD_NAME_PATTERN, SHARD_PREFIX
from tackroom.sources.ledger import among

ORDER_COLS = ["shard", "file_path", "block_start", "row_id"]
LINE_SCHEMA = ("shard string, file_path string, block_start long, row_id long, line string, "
               "file_name string")


def _empty_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LINE_SCHEMA)


def read_shard_lines(spark: SparkSession, root: str, pattern: str = SHARD_NAME_PATTERN,
                     glob: str = SHARD_NAME_GLOB, layout: str = "files",
                     consumed: DataFrame | None = None) -> DataFrame:
    """Every line of every matching shard with its order key.

    ``consumed`` is the ledger of already-merged file names (S4); those files
    are left out with an anti-join, which AQE broadcasts when the ledger is small.
    """
    reader = spark.read.format("text")
    if layout == "files":
        reader = reader.option("pathGlobFilter", glob)
    try:
        raw = reader.load(root)
    except AnalysisException:
        return _empty_lines(spark)
    meta = raw.select("*", F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_block_start").alias("block_start"),
                      F.monotonically_increasing_id().alias("row_id"))
    if layout == "files":
        meta = meta.where(F.col("file_name").rlike(pattern)).withColumn("shard", F.col("file_name"))
    elif layout == "partitioned":
        meta = meta.where(F.col("shard").rlike(pattern))
    else:
        raise ValueError(layout)
    lines = meta.select(*ORDER_COLS, F.col("value").alias("line"), "file_name")
    if consumed is not None:
        lines = among(lines, consumed, "left_anti")
    return lines


def list_shards(spark: SparkSession, root: str, pattern: str = SHARD_NAME_PATTERN, glob: str = SHARD_NAME_GLOB,
                layout: str = "files", consumed: DataFrame | None = None) -> DataFrame:
    """Every matching shard file, empty ones too (S1): (shard, file_path, file_name, length).

    Only names and lengths are listed, one row per file; no content is read.
    """
    if layout not in ("files", "partitioned"):
        raise ValueError(layout)
    jvm = spark.sparkContext._jvm
    inner = glob if layout == "files" else "shard=*/part-*"
    # file listing is the driver's work in Spark too, but its readers skip files of length 0
    found = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{inner}")
    status = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found) or []
    rows = [(st.getPath().getParent().getName() if layout == "partitioned" else st.getPath().getName(),
             st.getPath().toUri().toString(), st.getPath().getName(), st.getLen()) for st in status if st.isFile()]
    raw = spark.createDataFrame(rows, "shard string, file_path string, file_name string, length long")
    shard = F.col("shard") if layout == "files" else F.expr("substring(shard, 7)")
    files = raw.select(shard.alias("shard"), "file_path", "file_name", "length").where(F.col("shard").rlike(pattern))
    if consumed is not None:
        files = among(files, consumed, "left_anti")
    return files


def discover_shards(files: DataFrame) -> DataFrame:
    """Distinct shard names of a listing in merge order (lexicographic), one row each."""
    return files.select("shard").distinct().orderBy("shard")


def merge_summary(files: DataFrame, lines: DataFrame, master_name: str) -> DataFrame:
    """``mergedCount`` and ``masterFile`` of one merge (S5): every listed file counts, empty ones too."""
    n_files = files.agg(F.count_distinct("file_path").alias("merged_count"))
    n_lines = lines.agg(F.count(F.lit(1)).alias("line_count"))
    return n_files.crossJoin(F.broadcast(n_lines)).withColumn("master_file", F.lit(master_name))


def write_master(lines: DataFrame, out: str) -> None:
    """Physical master: all lines in merge order (range-partitioned sort)."""
    lines.orderBy(*ORDER_COLS).select("line").write.mode("errorifexists").text(out)


def retire_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Delete the merged shard files (S4), only ever called after the master is
    committed. A file that cannot be removed is reported, not raised: the
    ledger already keeps it out of the next merge. Returns the failures.
    """
    import logging
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    failed = []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        try:
            if not path.getFileSystem(conf).delete(path, False):
                failed.append(name)
        except Exception:  # noqa: BLE001 - a failed removal is a warning
            failed.append(name)
    for f in failed:
        logging.getLogger("tackroom").warning("could not remove merged shard %s", f)
    return failed


def shard_file_name(lo: F.Column, hi: F.Column, stamp_millis: int,
                    prefix: str = SHARD_PREFIX) -> F.Column:
    """``<prefix>_<lo>_to_<hi>_<millis>.ndjson``."""
    return F.concat(F.lit(prefix + "_"), lo.cast("string"), F.lit("_to_"), hi.cast("string"),
                    F.lit(f"_{stamp_millis}.ndjson"))


def shard_of(key: str, start: int, size: int, stamp_millis: int, prefix: str) -> F.Column:
    """Shard name of an id's batch. An id that is NULL, NaN or below ``start``, or a batch below 0, fails the write: no
    reader matches such a shard, so its rows would be lost."""
    b = F.floor((F.col(key) - F.lit(start)) / F.lit(size))
    lo = F.lit(start) + b * F.lit(size)
    name = shard_file_name(lo, lo + F.lit(size - 1), stamp_millis, prefix)
    fits = (F.col(key) >= F.lit(max(start, 0))) & ~F.isnan(F.col(key).cast("double")) & (lo >= 0)
    says = F.concat(F.lit(f"id in {key} out of range, from {start}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    return F.when(fits, name).otherwise(F.raise_error(says).cast("string"))


def write_batch_shards(df: DataFrame, out: str, key: str, start: int, size: int,
                       stamp_millis: int, prefix: str = SHARD_PREFIX) -> DataFrame:
    """One NDJSON shard per id batch (S6); nulls are written, not omitted.

    Batch ``b`` covers ids ``start + (b-1)*size .. start + b*size - 1``. Rows are
    hash-partitioned by shard so each batch lands as one file; a batch holds at
    most ``size`` distinct ids, which bounds the task when ids are unique. An id
    that is NULL or below ``start`` fails the write, and nothing is landed. Returns the frame that was written (with its ``shard`` column).
    """
    tagged = df.withColumn("shard", shard_of(key, start, size, stamp_millis, prefix))
    # dynamic overwrite: a landing replaces exactly its own shard folders, so
    # a retried landing does not duplicate lines and other shards stay as they are
    (tagged.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("ignoreNullFields", "false").partitionBy("shard").json(out))
    return tagged


def write_line_shards(lines: DataFrame, out: str, key: str, start: int, size: int,
                      stamp_millis: int, line_col: str = "line", prefix: str = SHARD_PREFIX) -> None:
    """Raw text lines (already serialised) as one shard per key batch, in key order. A key that is NULL or below
    ``start`` fails the write, and nothing is landed."""
    tagged = lines.select(key, line_col, shard_of(key, start, size, stamp_millis, prefix).alias("shard"))
    (tagged.repartition("shard").sortWithinPartitions("shard", key).select("shard", line_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").text(out))


def cleaned_name(master_path: str, run_ts_iso: str) -> str:
    """Sibling path ``<base>_cleaned_deduped_<ts>`` with ``:`` and ``.`` made ``_``."""
    base = master_path.rstrip("/")
    if base.endswith(".ndjson"):
        base = base[: -len(".ndjson")]
    stamp = run_ts_iso.replace(":", "_").replace(".", "_")
    return f"{base}{CLEANED_SUFFIX}{stamp}"


def write_cleaned(kept: DataFrame, out: str, order_cols=ORDER_COLS, ordered: bool = True) -> None:
    """Kept source lines as text (S7), in first-seen order by default (a
    range-partitioned sort). ``ordered=False`` skips the total sort when the
    consumer does not need the order; each file is still sorted within."""
    if ordered:
        kept = kept.orderBy(*order_cols)
    else:
        kept = kept.sortWithinPartitions(*order_cols)
    kept.select("line").write.mode("errorifexists").text(out)
