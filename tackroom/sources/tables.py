"""Staging, the versioned keyed target, dated snapshots and scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tackroom.functions.inference import load_inferred
from tackroom.functions.jsonline import is_blank
from tackroom.functions.records import load_records


def load_staging(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 view: str | None = None, rejects: str | None = None) -> DataFrame:
    """NDJSON to a table (S8). With a schema, values are read as its types and one that does
    not fit fails the load (or goes to the ``rejects`` table); without one the types are found
    in an extra pass (see ``functions.inference``), and only a line that is no JSON object is a misfit.
    Blank lines are no records."""
    lines = spark.read.text(path)
    if schema is not None:
        df = load_records(lines.where(~is_blank(F.col("value"))), schema, "value", rejects)
    else:
        df = load_inferred(lines, "value", rejects)
    if view:
        df.createOrReplaceTempView(view)
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Highest committed ``v=<n>`` folder under ``root`` (metadata listing only)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return None
    best = None
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                n = int(name[2:])
                best = n if best is None or n > best else best
    return best


def _table_name(root: str, version: int) -> str:
    import hashlib
    return f"tackroom_target_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:12]}_v{version}"


def _spec_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_bucketing/v={version}"


def bucket_spec(spark: SparkSession, root: str, version: int | None = None) -> tuple[str, int] | None:
    """(key, buckets) that a version was written with; None for an unbucketed one."""
    version = latest_version(spark, root) if version is None else version
    if version is None:
        return None
    fs, p = _fs(spark, _spec_path(root, version))
    if not fs.exists(p):
        return None
    row = spark.read.schema("key string, buckets int").json(_spec_path(root, version)).first()
    return row["key"], row["buckets"]


def read_target(spark: SparkSession, root: str, schema: StructType | str | None = None,
                key: str | None = None, buckets: int | None = None) -> DataFrame | None:
    """The current version of the keyed table (S9); None when nothing is committed.

    A version written with buckets is registered as a table bucketed the way
    that is stored with it (the bucket id is in each file name), so a join on
    the key reads it in place: only the other side is shuffled. ``key`` and
    ``buckets`` need not be given; other values than the stored ones are an
    error, as files would be left out.
    """
    v = latest_version(spark, root)
    if v is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    path = f"{root.rstrip('/')}/v={v}"
    spec = bucket_spec(spark, root, v)
    if spec is None:
        return spark.read.parquet(path)
    if (key is not None and key != spec[0]) or (buckets is not None and int(buckets) != spec[1]):
        raise ValueError(f"{path} is bucketed by {spec[0]} into {spec[1]}, not by {key} into {buckets}")
    keyed, free = _parts(spark, root, v)
    return keyed if free is None else keyed.unionByName(free)


def _null_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_null_keys/v={version}"


def _parts(spark: SparkSession, root: str, version: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a key, rows without one or None) of a version. Rows without a key match nothing, so a bucketed version
    keeps them beside its buckets: all of them would be in one."""
    path, spec = f"{root.rstrip('/')}/v={version}", bucket_spec(spark, root, version)
    if spec is None:
        return spark.read.parquet(path), None
    name = _table_name(root, version)
    if not spark.catalog.tableExists(name):
        # stored with the version, which may have no row and so no file
        ddl = spark.read.schema("ddl string").json(_spec_path(root, version)).first()["ddl"] or spark.read.parquet(path).schema.toDDL()
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({ddl}) USING parquet "
                  f"CLUSTERED BY (`{spec[0]}`) SORTED BY (`{spec[0]}`) INTO {spec[1]} BUCKETS LOCATION '{path}'")
    fs, p = _fs(spark, _null_path(root, version))
    return spark.table(name), spark.read.schema(spark.table(name).schema).parquet(_null_path(root, version)) if fs.exists(p) else None


def write_target(df: DataFrame, root: str, key: str | None = None, buckets: int | None = None,
                 version: int | None = None) -> int:
    """Write a new version next to the one being read, never over it.

    Readers pick the highest version with a ``_SUCCESS`` marker, so the switch
    is atomic and a failed write leaves the previous version current. With
    ``key`` and ``buckets`` the version is bucketed on the key; rows arriving
    already hash-partitioned the same way (as :func:`upsert` leaves them) are
    written without another shuffle. Rows without a key are written beside the
    buckets by the tasks that hold them.
    """
    if key and buckets:
        free = df.where(F.col(key).isNull())
        return _write_version(df.where(F.col(key).isNotNull()), None if free.isEmpty() else free, root, key, buckets, version)
    return _write_version(df, None, root, None, None, version)


def _write_version(df: DataFrame, free: DataFrame | None, root: str, key: str | None, buckets: int | None, version: int | None = None) -> int:
    """Commit a version: ``df``, bucketed if ``buckets`` is given, and the rows without a key."""
    spark = df.sparkSession
    v = version if version is not None else (latest_version(spark, root) or 0) + 1
    path = f"{root.rstrip('/')}/v={v}"
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.exists(p):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
            raise FileExistsError(f"version {v} is already committed under {root}")
        fs.delete(p, True)  # leftovers of a failed attempt; no reader ever used them
    if key and buckets:
        # stored before the data commits, so that no reader meets the files without it
        spark.range(1).select(F.lit(key).alias("key"), F.lit(int(buckets)).alias("buckets"), F.lit(df.schema.toDDL()).alias("ddl")) \
            .coalesce(1).write.mode("overwrite").json(_spec_path(root, v))
        if free is not None:
            free.write.mode("overwrite").parquet(_null_path(root, v))
        (df.write.mode("errorifexists").format("parquet").bucketBy(int(buckets), key).sortBy(key)
         .option("path", path).saveAsTable(_table_name(root, v)))
    else:
        df.write.mode("errorifexists").parquet(path)
    return v


def _count_path(root: str) -> str:
    return f"{root.rstrip('/')}_rows"


def _stored_rows(spark: SparkSession, root: str, state: str) -> int | None:
    """Rows of the target at ``state`` (a version, or a run of a ranged target), if they were stored with it."""
    fs, p = _fs(spark, f"{_count_path(root)}/state={state}/_SUCCESS")
    return spark.read.schema("n long").json(f"{_count_path(root)}/state={state}").first()["n"] if fs.exists(p) else None


def _store_rows(spark: SparkSession, root: str, state: str, rows: int) -> None:
    spark.range(1).select(F.lit(rows).cast("long").alias("n")).coalesce(1).write.mode("overwrite").json(f"{_count_path(root)}/state={state}")


def _report(spark: SparkSession, before: int, source: int, matched: int, after: int) -> DataFrame:
    from tackroom.operators.upsert import COUNTS, with_balance
    return with_balance(spark.createDataFrame([(before, source, matched, after)], ", ".join(f"{c} long" for c in COUNTS)))


def upsert_version(source: DataFrame, root: str, key: str, run_ts: str, buckets: int | None = None) -> DataFrame:
    """J2 on the versioned target, and its reconciliation row (A3).

    The rows that are kept and those that are new are counted by ``observe`` while the
    version is written, in the stage that writes it; the rows before it were stored
    with the last version, and those after it are the row counts in the files' footers.
    No row of the target is read for the reconciliation. A bucketed target keeps its
    bucket count, and rows without a key are moved beside its buckets unread by the join.
    """
    from tackroom.operators.upsert import NEW_ROW, upsert

    spark = source.sparkSession
    current = latest_version(spark, root)
    seen, tags = Observation(), [F.count_if(~F.col(NEW_ROW)).alias("kept"), F.count_if(F.col(NEW_ROW)).alias("new")]
    stamped = source.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    if current is None:
        keyed, free = (stamped.withColumn(NEW_ROW, F.lit(True)), None)
        before, old_free = 0, 0
    else:
        spec = bucket_spec(spark, root, current)
        buckets = spec[1] if spec else None
        target, free = _parts(spark, root, current)
        before = _stored_rows(spark, root, f"v{current}")
        old_free = 0 if free is None else free.count()
        before = target.count() + old_free if before is None else before
        keyed = upsert(target, source.where(F.col(key).isNotNull()) if buckets else source, key, run_ts, buckets=buckets, tagged=True)
    new_free = 0
    if buckets:
        own = stamped.where(F.col(key).isNull())
        keyed, new_free = keyed.where(F.col(key).isNotNull()), own.count()
        if new_free:
            own = own.repartition(int(buckets), F.xxhash64(*own.columns))
            free = own if free is None else free.unionByName(own.select(*free.columns))
    v = _write_version(keyed.observe(seen, *tags).drop(NEW_ROW), free, root, key if buckets else None, buckets)
    got = seen.get
    stored = spark.read.schema(keyed.drop(NEW_ROW).schema)
    after = stored.parquet(f"{root.rstrip('/')}/v={v}").count() + (stored.parquet(_null_path(root, v)).count() if free is not None else 0)
    if after != got["kept"] + got["new"] + old_free + new_free:
        raise RuntimeError(f"version {v} of {root} holds {after} rows, not the {got['kept'] + got['new'] + old_free + new_free} written")
    _store_rows(spark, root, f"v{v}", after)
    return _report(spark, before, got["new"] + new_free, before - old_free - got["kept"], after)


def snapshot_suffix(run_ts: F.Column) -> F.Column:
    """``YYYYMMDD`` of a UTC timestamp."""
    return F.date_format(run_ts, "yyyyMMdd")


def write_snapshot(df: DataFrame, root: str, yyyymmdd: str) -> None:
    """Dated training table (S10): one ``snapshot_date=`` partition per day,
    replaced in place by a rerun on the same day (dynamic partition overwrite)."""
    (df.withColumn("snapshot_date", F.lit(yyyymmdd)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(root))


def read_snapshot(spark: SparkSession, root: str, yyyymmdd: str) -> DataFrame:
    """One day's snapshot: only that partition folder is listed and read."""
    df = spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/snapshot_date={yyyymmdd}")
    return df.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def read_instances(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Scoring requests (S11): each file holds a bare JSON array, or an object with ``instances``
    (absent or null: no rows); a folder may hold both kinds. ``schema`` is that of one instance, and is
    inferred over all instances if not given. Columns: file_path, file_name, idx (the 0-based position
    in its file) and the instance's fields. A file that is not JSON fails the read.
    """
    doc = (spark.read.text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                   F.parse_json("value").alias("doc")))
    bare = F.schema_of_variant("doc").startswith("ARRAY")
    listed = F.when(bare, F.col("doc")).otherwise(F.try_variant_get("doc", "$.instances", "variant"))
    rows = doc.select("file_path", "file_name", listed.alias("list")).where(F.schema_of_variant("list").startswith("ARRAY")) \
              .select("file_path", "file_name", F.posexplode(F.col("list").cast("array<variant>")).alias("idx", "inst"))
    if schema is None:
        shape = rows.agg(F.schema_of_variant_agg("inst")).first()[0]
        if not shape or not shape.startswith("OBJECT<"):
            return rows.select("file_path", "file_name", "idx")
        ddl = shape.replace("OBJECT<", "STRUCT<")
    else:
        kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        if kind.names == ["instances"]:  # the schema of the whole request object
            kind = kind["instances"].dataType.elementType
        ddl = kind.simpleString()
    return rows.select("file_path", "file_name", "idx", F.variant_get("inst", "$", ddl).alias("r")) \
               .select("file_path", "file_name", "idx", "r.*")


RANGE_COL = "_range"


def key_range(key: F.Column, width: int) -> F.Column:
    """Range partition of a key: ``floor(key / width)`` (NULL keys -> NULL)."""
    return F.floor(key / F.lit(width)).cast("long")


def _by_range(df: DataFrame, key: str) -> DataFrame:
    """One write task per key range (so one file per range); rows with a NULL
    key, which always insert and share one range, are spread by a row hash
    over the whole shuffle width."""
    salt = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in df.columns]))
    return df.repartition(F.col(RANGE_COL), salt.otherwise(F.lit(0)))


def read_ranged(spark: SparkSession, root: str) -> DataFrame | None:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return None
    return spark.read.parquet(root)


def upsert_ranged(source: DataFrame, root: str, key: str, run_ts: str, width: int, scratch: str) -> DataFrame:
    """Incremental J2 on a target partitioned by key range (``_range=<n>``).

    Only the ranges present in the source are rewritten (dynamic partition
    overwrite). The read is pruned to the span between the smallest and the
    largest of them, and a semi-join on the distinct ranges, at every size,
    leaves the others out. Ids arriving in contiguous batches touch one range
    each. The merged ranges are first written to ``scratch`` because a job
    cannot overwrite partitions it is reading; a failure before the swap
    leaves the target as it was, and a rerun of the same source is idempotent
    apart from ``updated_at``. Returns the reconciliation row (A3), counted while the
    ranges are written; ranges that the source does not touch are not read for it.
    """
    from tackroom.operators.upsert import NEW_ROW, upsert

    spark = source.sparkSession
    # the source feeds both the touched-range list and the merge: write it once
    # (this also cuts its lineage, so a lost executor does not redo the parse)
    source.withColumn(RANGE_COL, key_range(F.col(key), width)).write.mode("errorifexists") \
        .parquet(f"{scratch}/source")
    src = spark.read.parquet(f"{scratch}/source")
    current = read_ranged(spark, root)
    seen, tags = Observation(), [F.count_if(~F.col(NEW_ROW)).alias("kept"), F.count_if(F.col(NEW_ROW)).alias("new")]
    if current is None:  # first load: nothing is read, so write in place
        first = src.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
        _by_range(first, key).observe(seen, F.count(F.lit(1)).alias("new")).write.mode("errorifexists").partitionBy(RANGE_COL).parquet(root)
        _store_rows(spark, root, "ranged", seen.get["new"])
        return _report(spark, 0, seen.get["new"], 0, spark.read.parquet(root).count())
    span = src.agg(F.min(RANGE_COL).alias("lo"), F.max(RANGE_COL).alias("hi"),
                   F.count_if(F.col(RANGE_COL).isNull()).alias("nulls")).first()
    before = _stored_rows(spark, root, "ranged")
    before = current.count() if before is None or before < 0 else before   # from the files' footers
    if span["lo"] is None:
        touched = current.limit(0)
    else:
        within = F.col(RANGE_COL).between(span["lo"], span["hi"])
        touched = current.where(within).join(src.where(within).select(RANGE_COL).distinct(), RANGE_COL, "left_semi") \
                         .select(*current.columns)
    # a folder's rows are counted from the footers of the touched ranges
    held = touched.count()
    merged = upsert(touched, src.where(F.col(key).isNotNull()), key, run_ts, tagged=True)
    _by_range(merged, key).observe(seen, *tags).drop(NEW_ROW).write.mode("errorifexists").parquet(f"{scratch}/merged")
    got = seen.get
    parts = [f"{scratch}/merged"]
    if span["nulls"]:  # rows without a key match nothing: they join those that are there
        free = src.where(F.col(key).isNull()).withColumn("updated_at", F.lit(run_ts).cast("timestamp")).select(*current.columns)
        _by_range(free.unionByName(current.where(F.col(RANGE_COL).isNull())), key).write.mode("errorifexists").parquet(f"{scratch}/nulls")
        parts.append(f"{scratch}/nulls")
    _store_rows(spark, root, "ranged", -1)   # unknown, should the run end during the swap
    (spark.read.parquet(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE_COL).parquet(root))
    after = before + got["kept"] + got["new"] + span["nulls"] - held
    _store_rows(spark, root, "ranged", after)
    return _report(spark, before, got["new"] + span["nulls"], held - got["kept"], after)
