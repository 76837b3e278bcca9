"""A keyed target that is merged when it is read.

An upsert of a versioned target rewrites all of it. Here a run writes only its
own rows, as a delta beside the base; a reader takes the newest row of each key.
The table is a folder of Parquet files and a manifest: for every commit a small
Parquet table that lists all live files with their rows, NULL keys and smallest
and largest key, and one row for each commit so far with what it counted while
writing. The manifest is written after its data, so a failed run leaves the
commit before it current; one writer at a time is assumed, and a second one that
takes the same number fails.

* Files hold ranges of keys (range partitioning, sorted), so the smallest and
  largest keys tell most of them apart: a read between two keys opens the files
  that can hold one, and base files that no delta overlaps are read as they are.
* Only base files that a delta overlaps are joined, against the deltas' keys;
  Spark broadcasts these when they are small.
* ``compact`` folds the deltas into the base files that they overlap and carries
  the other files over by name. Its counts are taken by ``observe`` on the very
  frame that is written, in the last stage, where Spark counts each task once;
  the counts of rows that were there come from the manifest.
* Rows with a NULL key never match. They are spread over the files by a hash.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tackroom.operators.upsert import assert_unique_source
from tackroom.sources.tables import _fs

COMMIT_COL = "_commit"     # the commit that wrote a row, in every data file
BASE, DELTA, LOG = "base", "delta", "commit"
_COUNTS = ("rows_source", "rows_before", "rows_replaced", "rows_inserted", "rows_after")


def _manifest_dir(root: str, commit: int | None = None) -> str:
    folder = f"{root.rstrip('/')}/_manifest"
    return folder if commit is None else f"{folder}/n={commit:010d}"


def latest_commit(spark: SparkSession, root: str) -> int | None:
    """The newest commit with a complete manifest."""
    fs, p = _fs(spark, _manifest_dir(root))
    if not fs.exists(p):
        return None
    done = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("n=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done.append(int(name[2:]))
    return max(done, default=None)


def _manifest_schema(key_type: DataType) -> StructType:
    fields = StructType.fromDDL("commit long, kind string, file string, rows long, nulls long")
    fields = fields.add("lo", key_type).add("hi", key_type)
    return StructType([*fields.fields, *StructType.fromDDL("op string, txn string, run_ts string, " + ", ".join(f"{c} long" for c in _COUNTS)).fields])


def manifest(spark: SparkSession, root: str, commit: int | None = None) -> DataFrame | None:
    """All rows of one manifest (the newest): live files, and with ``kind`` commit one row for each commit so far."""
    commit = latest_commit(spark, root) if commit is None else commit
    return None if commit is None else spark.read.parquet(_manifest_dir(root, commit))


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row a commit: op, txn, run_ts and its counts (NULL where the commit does not know them)."""
    return manifest(spark, root).where(F.col("kind") == LOG).select("commit", "op", "txn", "run_ts", *_COUNTS)


def _state(spark: SparkSession, root: str) -> tuple[int | None, list, list]:
    """(newest commit, its live files, rows of all commits): metadata, one row a file or commit."""
    commit = latest_commit(spark, root)
    rows = [] if commit is None else manifest(spark, root, commit).collect()
    return commit, sorted((r for r in rows if r["kind"] != LOG), key=lambda r: (r["commit"], r["file"])), [r for r in rows if r["kind"] == LOG]


def _overlaps(f, spans: list[tuple]) -> bool:
    return f["lo"] is not None and any(a <= f["hi"] and f["lo"] <= b for a, b in spans)


def _spans(files: list) -> list[tuple]:
    """The key ranges of files, merged where they overlap."""
    out: list[tuple] = []
    for lo, hi in sorted((f["lo"], f["hi"]) for f in files if f["lo"] is not None):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _within(files: list, lo, hi) -> list:
    """The files that can hold a key from ``lo`` to ``hi`` (None: open); with a bound, rows without a key are not asked for."""
    if lo is None and hi is None:
        return files
    return [f for f in files if f["lo"] is not None and (hi is None or f["lo"] <= hi) and (lo is None or lo <= f["hi"])]


def _open(spark: SparkSession, root: str, files: list, schema) -> DataFrame:
    """The rows of some files."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f['file']}" for f in files])


def _newest(deltas: DataFrame, key: str) -> DataFrame:
    """The newest delta row of each key, and all rows without a key."""
    cols = deltas.columns
    latest = deltas.where(F.col(key).isNotNull()).groupBy(key) \
        .agg(F.max_by(F.struct(*[c for c in cols if c != key]), COMMIT_COL).alias("_row")) \
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in cols])
    return latest.unionByName(deltas.where(F.col(key).isNull()))


def _spread(df: DataFrame, key: str, files: int | None) -> DataFrame:
    """Ranges of keys; rows without one are dealt by a hash of the row."""
    salt = F.when(F.col(key).isNull(), F.xxhash64(*df.columns))
    by_range = df.repartitionByRange(files, F.col(key), salt) if files else df.repartitionByRange(F.col(key), salt)
    return by_range.sortWithinPartitions(key)


def _write(df: DataFrame, root: str, key: str, commit: int, kind: str, files: int | None, **counts: Column) -> tuple[list, dict]:
    """Write the rows as files of one folder. Returns their manifest rows, and the ``counts`` taken while they were written;
    a count of rows that differs from what the files hold is an error."""
    spark = df.sparkSession
    folder = f"data/{commit:010d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    tags = [c for c in df.columns if c.startswith("_tag")]
    # observed after the last exchange: the counts of a result stage are taken once for each of its tasks
    _spread(df, key, files).observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]) \
        .drop(*tags).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{folder}")
    got = seen.get
    stored = spark.read.schema(df.drop(*tags).schema).parquet(f"{root.rstrip('/')}/{folder}")
    per_file = stored.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    listed = [Row(commit=commit, kind=kind, file=f"{folder}/{r['file']}", rows=r["rows"], nulls=r["nulls"], lo=r["lo"], hi=r["hi"])
              for r in per_file.collect()]  # one row a file
    held = sum(f["rows"] for f in listed)
    if held != got["rows"]:
        raise RuntimeError(f"{got['rows']} rows were written to {folder}, which holds {held}")
    return listed, got


def _commit(spark: SparkSession, root: str, key_type: DataType, commit: int, files: list, op: str, txn: str | None,
            run_ts: str | None, counts: dict, before: list) -> None:
    """Write the manifest of a commit: ``files`` are all that live from now on, ``before`` the commits so far."""
    entry = {"commit": commit, "kind": LOG, "op": op, "txn": txn, "run_ts": run_ts, **counts}
    schema = _manifest_schema(key_type)
    rows = [tuple(r.get(c) for c in schema.names) for r in [*(f.asDict() for f in [*files, *before]), entry]]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(_manifest_dir(root, commit))


def applied(spark: SparkSession, root: str, txn: str) -> bool:
    """Whether a commit with this ``txn`` is in the table."""
    return any(r["txn"] == txn for r in _state(spark, root)[2])


def pending_deltas(spark: SparkSession, root: str) -> int:
    """Number of commits that wait to be folded into the base."""
    return len({f["commit"] for f in _state(spark, root)[1] if f["kind"] == DELTA})


def upsert_delta(source: DataFrame, root: str, key: str, run_ts: str, txn: str | None = None, files: int | None = None,
                 ts_col: str = "updated_at") -> int | None:
    """J2 in O(source): matched rows are replaced and others inserted when the table is read.

    The first commit is the base. A key that appears twice in ``source`` is an error.
    With ``txn`` (say, a stream's id and batch number) a commit that is already
    there is left alone, and None is returned; else the commit's number. ``files``
    fixes the number of files (otherwise Spark sizes them).
    """
    spark = source.sparkSession
    before, live, log = _state(spark, root)
    if txn is not None and any(r["txn"] == txn for r in log):
        return None
    commit = 0 if before is None else before + 1
    rows = source.withColumn(ts_col, F.lit(run_ts).cast("timestamp")).withColumn(COMMIT_COL, F.lit(commit).cast("long"))
    if before is not None:
        want = _schema(spark, root)
        if sorted((f.name, f.dataType.simpleString()) for f in want) != sorted((f.name, f.dataType.simpleString()) for f in rows.schema):
            raise ValueError(f"the target has {want.simpleString()}, the source {rows.schema.simpleString()}")
        rows = rows.select(*want.names)
    assert_unique_source(source, key)
    listed, got = _write(rows, root, key, commit, BASE if before is None else DELTA, files)
    counts = {"rows_source": got["rows"]}
    if before is None:
        counts |= {"rows_before": 0, "rows_replaced": 0, "rows_inserted": got["rows"], "rows_after": got["rows"]}
        _store_schema(spark, root, rows)
    _commit(spark, root, rows.schema[key].dataType, commit, [*live, *listed], "upsert", txn, run_ts, counts, log)
    return commit


def _store_schema(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """The table's columns, kept by themselves, since a commit may have no files at all."""
    spark.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}/_schema")


def _schema(spark: SparkSession, root: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(f"{root.rstrip('/')}/_schema").first()[0]))


def files_read(spark: SparkSession, root: str, lo=None, hi=None) -> tuple[int, int]:
    """(files that a read between two keys opens, live files)."""
    files = _state(spark, root)[1]
    return len(_within(files, lo, hi)), len(files)


def read_merged(spark: SparkSession, root: str, key: str, lo=None, hi=None) -> DataFrame | None:
    """The table: the newest row of every key, and every row without one. With ``lo`` or ``hi``, the rows with a key between
    them (both inclusive), from the files that can hold one. None when nothing is committed."""
    commit, files, _ = _state(spark, root)
    if commit is None:
        return None
    schema = _schema(spark, root)
    files = _within(files, lo, hi)
    deltas = [f for f in files if f["kind"] == DELTA]
    base = [f for f in files if f["kind"] == BASE]
    spans = _spans(deltas)
    alone = [f for f in base if not _overlaps(f, spans)]
    shared = [f for f in base if _overlaps(f, spans)]
    out = _open(spark, root, alone, schema)
    if deltas:
        newest = _newest(_open(spark, root, deltas, schema), key)
        kept = _open(spark, root, shared, schema).join(newest.select(key).where(F.col(key).isNotNull()), key, "left_anti")
        out = out.unionByName(kept.select(*schema.names)).unionByName(newest.select(*schema.names))
    if lo is not None:
        out = out.where(F.col(key) >= F.lit(lo))
    if hi is not None:
        out = out.where(F.col(key) <= F.lit(hi))
    return out.drop(COMMIT_COL)


def compact(spark: SparkSession, root: str, key: str, files: int | None = None) -> int | None:
    """Fold all deltas into the base; base files that no delta overlaps stay as they are. None if there is no delta.

    The commit's counts reconcile the table without reading it (A3): the rows of
    the base before it are in the manifest, those kept and added are counted as
    they are written.
    """
    current, live, log = _state(spark, root)
    deltas = [f for f in live if f["kind"] == DELTA]
    if not deltas:
        return None
    schema, commit = _schema(spark, root), current + 1
    base = [f for f in live if f["kind"] == BASE]
    spans = _spans(deltas)
    alone = [f for f in base if not _overlaps(f, spans)]
    shared = [f for f in base if _overlaps(f, spans)]
    newest = _newest(_open(spark, root, deltas, schema), key)
    kept = _open(spark, root, shared, schema).join(newest.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    merged = kept.select(*schema.names, F.lit(True).alias("_tag_kept")) \
        .unionByName(newest.select(*schema.names, F.lit(False).alias("_tag_kept")))
    listed, got = _write(merged, root, key, commit, BASE, files, kept=F.count_if("_tag_kept"))
    rows = lambda some: sum(f["rows"] for f in some)
    added, replaced = got["rows"] - got["kept"], rows(shared) - got["kept"]
    counts = {"rows_source": rows(deltas), "rows_before": rows(base), "rows_replaced": replaced, "rows_inserted": added - replaced,
              "rows_after": rows(alone) + got["rows"]}
    _commit(spark, root, schema[key].dataType, commit, [*alone, *listed], "compact", None, None, counts, log)
    return commit


def reconcile_log(spark: SparkSession, root: str) -> DataFrame:
    """A3 from the manifest alone, one row for each commit that knows its counts: ``after = before + inserted``, and ``after``
    is what the files hold that the newest manifest lists, if the commit is the last with counts."""
    m = manifest(spark, root)
    held = m.where(F.col("kind") == BASE).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("held"))
    known = history(spark, root).where(F.col("rows_after").isNotNull())
    last = known.agg(F.max("commit").alias("last"))
    return known.crossJoin(F.broadcast(held)).crossJoin(F.broadcast(last)).select(
        "commit", "op", *_COUNTS,
        ((F.col("rows_after") == F.col("rows_before") + F.col("rows_inserted")) & (F.col("rows_replaced") >= 0)
         & ((F.col("commit") < F.col("last")) | (F.col("rows_after") == F.col("held")))).alias("balanced"))


def unused_files(spark: SparkSession, root: str) -> list[str]:
    """Data folders that no live file is in, by path: of compacted deltas and of runs that failed."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/data")
    used = {re.sub(r"/[^/]*$", "", f["file"]) for f in _state(spark, root)[1]}
    return [f"{root.rstrip('/')}/data/{st.getPath().getName()}" for st in fs.listStatus(p)
            if f"data/{st.getPath().getName()}" not in used] if fs.exists(p) else []


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of ``unused_files``, which readers of older manifests may still use. Returns them."""
    gone = unused_files(spark, root)
    for path in gone:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return gone
