"""Incremental shard consumption (T1) and incremental upsert.

The file source's checkpoint records which files were consumed, so each run
(``trigger(availableNow=True)``) sees only shards that landed since the last
one. ``cleanSource`` archives or deletes consumed files (lazily: files of the
last batch go on the next run). The upsert sink is ``foreachBatch``; a ledger
keyed by (stream, batch id), written after the data commits, skips replays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tackroom.constants import SHARD_NAME_GLOB, SHARD_NAME_PATTERN
from tackroom.functions.records import load_records
from tackroom.operators.clean import clean, dedupe_first, kept_lines
from tackroom.operators.upsert import assert_unique_source
from tackroom.session import scratch_dir
from tackroom.sources.ledger import consume, not_consumed
from tackroom.sources.merge_on_read import applied, compact, pending_deltas, upsert_delta
from tackroom.sources.shards import ORDER_COLS, list_shards
from tackroom.sources.tables import _fs, upsert_ranged, upsert_version


def shard_stream(spark: SparkSession, root: str, pattern: str = SHARD_NAME_PATTERN,
                 glob: str = SHARD_NAME_GLOB, layout: str = "files",
                 max_files: int | None = None, clean_source: str | None = None,
                 archive_dir: str | None = None) -> DataFrame:
    """Streaming lines of matching shards with (shard, file_path, block_start).

    The per-row part of the order key is added per micro-batch (see
    ``incremental_upsert``), where each batch is a plain file scan.
    """
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    if layout == "files":
        raw = r.option("pathGlobFilter", glob).load(root)
        shard = F.col("_metadata.file_name")
    elif layout == "partitioned":
        raw = r.load(f"{root.rstrip('/')}/shard=*")
        shard = F.regexp_extract(F.col("_metadata.file_path"), r"shard=([^/]+)/", 1)
    else:
        raise ValueError(layout)
    lines = raw.select(shard.alias("shard"), F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_block_start").alias("block_start"),
                       F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))
    return lines.where(F.col("shard").rlike(pattern))


def _list_now(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """The shard files that are there before a run starts: metadata, one row a file."""
    files = list_shards(spark, root, layout=layout)
    return spark.createDataFrame(files.select("file_path", "length").collect(), "file_path string, length long")


def _note_empty(listed: DataFrame, ledger: str, stream: str) -> None:
    """Empty shards give no rows, so those that were there when the run started are added to the ledger by name."""
    empty = listed.where(F.col("length") == 0)
    new = not_consumed(empty, ledger)
    if not new.isEmpty():
        consume(new, ledger, stream, f"{stream}-empty-{uuid.uuid4().hex}")


def _fresh(batch: DataFrame, ledger: str | None, run: str) -> DataFrame:
    """A micro-batch without the files that another run has consumed."""
    return batch if ledger is None else not_consumed(batch, ledger, run)


def incremental_shards(lines: DataFrame, sink: str, checkpoint: str, ledger: str | None = None, root: str | None = None,
                       layout: str = "files") -> None:
    """Append every new shard line to a Parquet table, once.

    With ``ledger`` (and the folder ``root`` that is read) batch runs and this stream
    share the table of consumed files: each leaves out what the other has taken,
    and empty shards are noted too. Each micro-batch then replaces its own folder of the
    sink, so that a repeated one adds nothing.
    """
    if ledger is None:
        q = (lines.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        return
    listed = _list_now(lines.sparkSession, root, layout)

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_of(batch.sparkSession)
        name = f"{stream}-{batch_id}"
        # written once: the sink's part and the file names are read from it
        (_fresh(batch, ledger, name).withColumn("run", F.lit(name)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(sink))
        taken = batch.sparkSession.read.schema(batch.schema.add("run", "string")).parquet(sink).where(F.col("run") == name)
        consume(taken, ledger, "stream", name)

    q = (lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    _note_empty(listed, ledger, "stream")


def _applied(spark: SparkSession, target_root: str, stream: str, batch_id: int):
    """Folder of the ledger that marks one micro-batch of one stream as applied, and whether it is there."""
    path = f"{target_root.rstrip('/')}_batches/stream={stream}/batch_id={batch_id}"
    fs, p = _fs(spark, path)
    return path, fs.exists(p)


def _mark(spark: SparkSession, path: str, run_ts: str) -> None:
    spark.range(1).select(F.lit(run_ts).alias("run_ts")).coalesce(1).write.mode("overwrite").parquet(path)


def _stream_of(spark: SparkSession) -> str:
    """The running query's id, which its checkpoint keeps across restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def _records(batch: DataFrame, schema: StructType | str, transform, rejects: str | None, key: str, on_dup: str) -> DataFrame:
    """The micro-batch's records, typed. Ids that differ as JSON (``7`` and ``"7"``) may be one key once they are typed: the first
    record of a key wins (``on_dup='first'``), or the batch fails (``'fail'``). Rows without a key are all kept."""
    if on_dup not in ("first", "fail"):
        raise ValueError(on_dup)
    ordered = batch if "row_id" in batch.columns else batch.withColumn("row_id", F.monotonically_increasing_id())
    rec = load_records(kept_lines(clean(ordered, ORDER_COLS)), schema, rejects=rejects, keep=ORDER_COLS)
    if on_dup == "first" and key in rec.columns:
        # a row without a key is a group of its own, known by its place: one pass types and groups all rows
        place = F.when(F.col(key).isNull(), F.struct(*ORDER_COLS))
        rec = dedupe_first(rec.withColumn("_place", place), [key, "_place"], ORDER_COLS).drop("_place")
    rec = rec.drop(*ORDER_COLS)
    if transform is not None:
        rec = transform(rec)
    # typed once: the unique check and the merge read it back
    path = scratch_dir(batch.sparkSession, "batch-records")
    rec.write.mode("errorifexists").parquet(path)
    rec = batch.sparkSession.read.schema(rec.schema).parquet(path)
    assert_unique_source(rec, key)
    return rec


def upsert_batch(batch: DataFrame, batch_id: int, target_root: str, schema: StructType | str, key: str,
                 run_ts: str, transform=None, buckets: int | None = None, stream: str | None = None,
                 rejects: str | None = None, on_dup: str = "first") -> bool:
    """One micro-batch of T2 as a new target version; False when it was applied before.

    A batch is known by its stream and number, in a ledger written after the
    version commits, so other streams, other checkpoints and batch loads of the
    same target never hide it. A failure between the two applies the batch once
    more, which replaces the same rows by themselves.
    """
    spark = batch.sparkSession
    ledger, done = _applied(spark, target_root, stream or _stream_of(spark), batch_id)
    if done:
        return False
    upsert_version(_records(batch, schema, transform, rejects, key, on_dup), target_root, key, run_ts, buckets)
    _mark(spark, ledger, run_ts)
    return True


def upsert_batch_ranged(batch: DataFrame, batch_id: int, target_root: str, schema: StructType | str, key: str,
                        run_ts: str, width: int, transform=None, stream: str | None = None,
                        rejects: str | None = None, on_dup: str = "first") -> bool:
    """One micro-batch of T2 on a range-partitioned target: only the key
    ranges in the batch are rewritten. Replays are known as in ``upsert_batch``."""
    spark = batch.sparkSession
    ledger, done = _applied(spark, target_root, stream or _stream_of(spark), batch_id)
    if done:
        return False
    records = _records(batch, schema, transform, rejects, key, on_dup)
    upsert_ranged(records, target_root, key, run_ts, width, scratch_dir(spark, "ranged-merge"))
    _mark(spark, ledger, run_ts)
    return True


def upsert_batch_delta(batch: DataFrame, batch_id: int, target_root: str, schema: StructType | str, key: str,
                       run_ts: str, transform=None, stream: str | None = None, rejects: str | None = None,
                       on_dup: str = "first", compact_after: int | None = None) -> bool:
    """One micro-batch of T2 as a delta of a target that is merged when read: it writes its own rows only. The batch is
    named in the commit, so a replay is known by the table itself. ``compact_after`` deltas are folded into the base."""
    spark = batch.sparkSession
    txn = f"{stream or _stream_of(spark)}/{batch_id}"
    if applied(spark, target_root, txn):
        return False
    upsert_delta(_records(batch, schema, transform, rejects, key, on_dup), target_root, key, run_ts, txn=txn)
    if compact_after is not None and pending_deltas(spark, target_root) >= compact_after:
        compact(spark, target_root, key)
    return True


def incremental_upsert(lines: DataFrame, target_root: str, checkpoint: str, schema: StructType | str,
                       key: str, run_ts: str, transform=None, buckets: int | None = None,
                       range_width: int | None = None, rejects: str | None = None, on_dup: str = "first",
                       merge_on_read: bool = False, compact_after: int | None = None, ledger: str | None = None,
                       root: str | None = None, layout: str = "files") -> None:
    """Each micro-batch is cleaned (first wins inside the batch), parsed with
    ``schema``, optionally reshaped by ``transform`` and upserted; later
    batches replace earlier rows of the same key.

    ``range_width`` selects the range-partitioned target (each batch rewrites
    only the key ranges it touches, :func:`upsert_batch_ranged`), ``merge_on_read`` the one that
    takes deltas (:func:`upsert_batch_delta`); otherwise the target is versioned
    (:func:`upsert_batch`), bucketed on ``key`` when ``buckets`` is given. With ``ledger``
    (and the folder ``root`` that is read) batch runs and the stream share the
    table of consumed files, as in :func:`incremental_shards`.
    """
    listed = _list_now(lines.sparkSession, root, layout) if ledger else None

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{_stream_of(spark)}-{batch_id}"
        if ledger:  # taken once, so that the records and the file names are of the same files
            path = scratch_dir(spark, "batch-lines")
            _fresh(batch, ledger, name).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path)
            batch = spark.read.schema(batch.schema.add("row_id", "long")).parquet(path)
        shared = {"transform": transform, "rejects": rejects, "on_dup": on_dup}
        if range_width:
            upsert_batch_ranged(batch, batch_id, target_root, schema, key, run_ts, range_width, **shared)
        elif merge_on_read:
            upsert_batch_delta(batch, batch_id, target_root, schema, key, run_ts, compact_after=compact_after, **shared)
        else:
            upsert_batch(batch, batch_id, target_root, schema, key, run_ts, buckets=buckets, **shared)
        if ledger:
            consume(batch, ledger, "stream", name)

    q = (lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if ledger:
        _note_empty(listed, ledger, "stream")
