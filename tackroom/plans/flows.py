"""Composite flows: clean job (E1), merge-clean-upsert (E2), train and rank."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tackroom.functions.records import load_records
from tackroom.operators.clean import clean, clean_report, kept_lines
from tackroom.operators.quarantine import hold_back, split_lines, split_records
from tackroom.operators.upsert import assert_unique_source
from tackroom.session import scratch_dir
from tackroom.sources.landing import list_landed, read_landed
from tackroom.sources.ledger import among, consume, not_consumed, read_ledger
from tackroom.sources.merge_on_read import compact, pending_deltas, reconcile_log, upsert_delta
from tackroom.sources.shards import ORDER_COLS, list_shards, read_shard_lines, write_cleaned
from tackroom.sources.tables import upsert_ranged, upsert_version


def clean_job(lines: DataFrame, out: str, order_cols: Sequence[str] = ORDER_COLS,
              keep: str = "first", ordered: bool = True, over_limits: str = "fail") -> DataFrame:
    """Clean lines into ``out`` (text) and return the report.

    The grouped table is written once to the shared folder; the cleaned text
    and the report are both read from it, so the JSON parse runs once and a
    lost executor only costs recomputing its own tasks. ``over_limits`` says what
    becomes of lines that the parser cannot judge (see ``classify_lines``).
    """
    spark = lines.sparkSession
    grouped_path = scratch_dir(spark, "clean-grouped")
    clean(lines, order_cols, keep=keep, over_limits=over_limits).write.mode("errorifexists").parquet(grouped_path)
    grouped = spark.read.parquet(grouped_path)
    write_cleaned(kept_lines(grouped), out, order_cols, ordered)
    return clean_report(grouped)


def merge_clean_upsert(spark: SparkSession, shards_root: str, target_root: str, schema: StructType | str,
                       key: str, run_ts: str, layout: str = "files", ledger: str | None = None,
                       reshape: Callable[[DataFrame], DataFrame] | None = None,
                       buckets: int | None = None, range_width: int | None = None,
                       rejects: str | None = None, over_limits: str = "fail", quarantine: str | None = None,
                       merge_on_read: bool = False, compact_after: int | None = None) -> DataFrame:
    """New shards -> clean -> parse -> (reshape) -> unique check -> upsert -> ledger -> reconciliation row.

    ``layout`` is files or partitioned (see ``sources.shards``) or manifest (``sources.landing``).

    The target is one of three kinds. By default each run writes a new version, with
    ``buckets`` bucketed on ``key`` so that only the new rows are shuffled (an existing
    target keeps the bucket count it was written with). With ``range_width`` it is
    partitioned by key range and a run rewrites only the ranges it touches (see
    ``upsert_ranged``). With ``merge_on_read`` a run adds its rows as a delta, and
    compacts the target once ``compact_after`` deltas are there; its reconciliation
    row is that of the last commit which knows its counts.

    A kept record whose value does not fit ``schema`` fails the run, or goes to the
    ``rejects`` table. With ``quarantine`` all defects go to that table instead, by
    class (see ``operators.quarantine``), and nothing in a line fails the run.
    """
    if layout == "manifest":
        files, lines = list_landed(spark, shards_root), read_landed(spark, shards_root)
    else:
        files, lines = list_shards(spark, shards_root, layout=layout), read_shard_lines(spark, shards_root, layout=layout)
    if ledger:
        files, lines = not_consumed(files, ledger), not_consumed(lines, ledger)
    # the listing is taken now: a shard that lands during the run is not in the ledger after it
    files = spark.createDataFrame(files.select("file_path").collect(), "file_path string")
    lines = among(lines, files)
    grouped_path, source_path = scratch_dir(spark, "flow-grouped"), scratch_dir(spark, "flow-source")
    if quarantine is not None:
        grouped, defects = split_lines(lines, grouped_path, ORDER_COLS)
        source, misfits = split_records(kept_lines(grouped), schema, scratch_dir(spark, "flow-typed"), ORDER_COLS)
        hold_back(defects, misfits, quarantine, run_ts)
        source = source.drop(*ORDER_COLS)
    else:
        clean(lines, ORDER_COLS, over_limits=over_limits).write.mode("errorifexists").parquet(grouped_path)
        source = load_records(kept_lines(spark.read.parquet(grouped_path)), schema, rejects=rejects)
    if reshape is not None:
        source = reshape(source)
    # parsed and typed once: the unique check and the upsert read it back
    source.write.mode("errorifexists").parquet(source_path)
    source = spark.read.parquet(source_path)
    if merge_on_read:
        upsert_delta(source, target_root, key, run_ts)
        if compact_after is not None and pending_deltas(spark, target_root) >= compact_after:
            compact(spark, target_root, key)
        report = reconcile_log(spark, target_root).orderBy(F.col("commit").desc()).limit(1).drop("commit", "op")
    elif range_width:
        assert_unique_source(source, key)
        report = upsert_ranged(source, target_root, key, run_ts, range_width, scratch_dir(spark, "flow-ranged"))
    else:
        assert_unique_source(source, key)
        report = upsert_version(source, target_root, key, run_ts, buckets)
    if ledger:
        consume(files, ledger)
    return report


def merge_job(spark: SparkSession, shards_root: str, out_dir: str, master_name: str,
              layout: str = "files", ledger: str | None = None, remove_merged: bool = False) -> DataFrame:
    """Merge step: discover shards (S1), write the master in merge order (S3),
    then record the consumed files in the ledger and, with ``remove_merged``,
    delete them (S4), and return the summary (S5).

    With no matching shard the outcome is explicit: one row with
    ``merged_count = 0`` and ``status = 'nothing_to_merge'``, and nothing is
    written. The ledger is appended only after the master is committed.
    """
    from tackroom.sources.shards import merge_summary, retire_files, write_master
    consumed = read_ledger(spark, ledger) if ledger else None
    files = list_shards(spark, shards_root, layout=layout, consumed=consumed)
    if files.isEmpty():
        return spark.createDataFrame([(0, 0, None, "nothing_to_merge")],
                                     "merged_count long, line_count long, master_file string, status string")
    lines = read_shard_lines(spark, shards_root, layout=layout, consumed=consumed)
    master = f"{out_dir.rstrip('/')}/{master_name}"
    write_master(lines, master)
    # one summary row, taken now: once shards are removed the listing is gone
    summary = merge_summary(files, spark.read.text(master), master_name).withColumn("status", F.lit("merged")).collect()
    listed = [r["file_path"] for r in files.select("file_path").collect()] if remove_merged else []  # one row per file
    if ledger:
        consume(files, ledger)
    if remove_merged:
        retire_files(spark, listed)
    return spark.createDataFrame(summary, "merged_count long, line_count long, master_file string, status string")
