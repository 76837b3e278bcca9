"""Keyed upsert with reconciliation.

``MERGE INTO`` needs a row-level-capable table format; on plain Parquet the
same result is ``target ANTI JOIN source  UNION ALL  source``: one shuffle of
both sides on the key (AQE broadcasts the source at runtime when the delta is
small, and splits skewed key partitions otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKey(ValueError):
    pass


def assert_unique_source(source: DataFrame, key: str, target: DataFrame | None = None,
                         on_dup: str = "any") -> None:
    """Fail when the source holds a key more than once.

    ``on_dup='any'`` (default) rejects every duplicate; ``'matched_only'`` only
    those whose key exists in the target, which is exactly what MERGE rejects.
    NULL keys never match, so they never count as duplicates.
    """
    keys = source.select(key).where(F.col(key).isNotNull())
    if on_dup == "matched_only":
        if target is None:
            return
        keys = keys.join(target.select(key), key, "left_semi")
    elif on_dup != "any":
        raise ValueError(on_dup)
    dup = keys.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateSourceKey(f"source key {dup[0][0]!r} appears {dup[0][1]} times")


NEW_ROW = "_from_source"


def upsert(target: DataFrame, source: DataFrame, key: str, run_ts: Column | str,
           ts_col: str = "updated_at", buckets: int | None = None, tagged: bool = False) -> DataFrame:
    """Matched rows replaced, source-only rows inserted, target-only kept.

    Every source row gets ``updated_at = run_ts`` (no change detection, so an
    identical row still moves its timestamp). Columns follow the target.
    With ``buckets`` (the target's bucket count on ``key``) the source is
    hash-partitioned to match, so against a bucketed target only the source
    is shuffled and the result can be written bucketed without a reshuffle.
    Rows with a NULL key can match nothing, so they are not hashed with the others.
    With ``tagged`` a column ``_from_source`` tells the source's rows, for counts.
    """
    ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts
    src = source.withColumn(ts_col, ts)
    keyed = src.where(F.col(key).isNotNull())
    if buckets:
        free = src.where(F.col(key).isNull())
        keyed = keyed.repartition(int(buckets), key)
        src = keyed.unionByName(free.repartition(int(buckets), F.xxhash64(*free.columns)))
    cols = target.columns
    # the target's rows without a key stay as they are, and stay out of the join's hash
    kept = target.where(F.col(key).isNotNull()).join(keyed.select(key), key, "left_anti").select(*cols) \
                 .unionByName(target.where(F.col(key).isNull()))
    if tagged:
        return kept.select(*cols, F.lit(False).alias(NEW_ROW)).unionByName(src.select(*cols, F.lit(True).alias(NEW_ROW)))
    return kept.select(*cols).unionByName(src.select(*cols))


COUNTS = ("rows_before", "rows_source", "rows_matched", "rows_after")


def with_balance(counts: DataFrame) -> DataFrame:
    """A3: ``after = before + inserted``, where the rows of the source that matched none are inserted."""
    return counts.select(*COUNTS, (F.col("rows_source") - F.col("rows_matched")).alias("rows_inserted")) \
                 .withColumn("balanced", F.col("rows_after") == F.col("rows_before") + F.col("rows_inserted"))


def reconcile_counts(target_before: DataFrame, source: DataFrame, target_after: DataFrame,
                     key: str) -> DataFrame:
    """A3 over three tables: ``after = before + inserted`` where inserted = source rows whose key
    is absent from the target (NULL keys always insert)."""
    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("k"), F.lit(1).alias("one"))

    matched = source.join(target_before.select(key).where(F.col(key).isNotNull()).distinct(),
                          key, "left_semi")
    parts = (tagged(target_before, "rows_before").unionByName(tagged(source, "rows_source"))
             .unionByName(tagged(matched, "rows_matched")).unionByName(tagged(target_after, "rows_after")))
    return with_balance(parts.agg(*[F.count_if(F.col("k") == n).cast("long").alias(n) for n in COUNTS]))
