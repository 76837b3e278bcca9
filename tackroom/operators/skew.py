"""Hot-group handling: size-split routing and an exact rank within a group
that never sends a whole group to one task.

``split_by_group_size`` counts rows per group by partial aggregation; only when
some group exceeds the bound does it join the counts back (AQE splits a
skewed join partition or broadcasts the small count table). Operators that
build one nested value per group use it to route groups above a size bound
to a tabular path that handles them exactly.

``rank_in_group`` gives each row its 0-based position within its group under
``order_cols``: rows are range-partitioned on (group, order) — so a hot group
spreads over many partitions — and numbered globally from per-partition counts
(one small row per partition); the rank is the row's global number minus the
smallest number in its group (partial aggregation again).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tackroom.functions.columns import GROUP_KEY, with_group_key
from tackroom.session import scratch_dir

DEFAULT_MAX_NESTED = 100_000


def with_group_size(df: DataFrame, group_cols: Sequence[str], name: str = "_gsize") -> DataFrame:
    keyed = with_group_key(df, group_cols)
    sizes = keyed.groupBy(GROUP_KEY).agg(F.count(F.lit(1)).alias(name))
    return keyed.join(sizes, GROUP_KEY, "inner").drop(GROUP_KEY)


def split_by_group_size(df: DataFrame, group_cols: Sequence[str], max_rows: int = DEFAULT_MAX_NESTED):
    """(small, hot): rows of groups with at most / more than ``max_rows`` rows.

    The group sizes are counted first (partial aggregation) and probed for
    one group above the bound, a single scalar read. Without a hot group the
    input is returned whole as ``small`` and ``hot`` is None, so the common
    case pays one counting pass and no join.
    """
    keyed = with_group_key(df, group_cols)
    sizes = keyed.groupBy(GROUP_KEY).agg(F.count(F.lit(1)).alias("_gsize"))
    if sizes.where(F.col("_gsize") > max_rows).limit(1).count() == 0:
        return df, None
    sized = keyed.join(sizes, GROUP_KEY, "inner").drop(GROUP_KEY)
    small = sized.where(F.col("_gsize") <= max_rows).drop("_gsize")
    hot = sized.where(F.col("_gsize") > max_rows).drop("_gsize")
    return small, hot


def rank_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  name: str = "_rank", partitions: int | None = None) -> DataFrame:
    """0-based exact rank of each row within its group by ``order_cols`` (ties
    in ``order_cols`` get distinct consecutive ranks)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    sorted_ = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # written once: two readings of a range partitioning could cut it at other sampled bounds
    path = scratch_dir(spark, "rank-in-group")
    sorted_.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")).write.parquet(path)
    numbered = spark.read.parquet(path)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    # one row per partition: a proven bound, so the offsets table is broadcast
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    indexed = numbered.join(F.broadcast(offsets), "_pid").withColumn("_gidx", F.col("_off") + local)
    keyed = with_group_key(indexed, group_cols)
    first = keyed.groupBy(GROUP_KEY).agg(F.min("_gidx").alias("_first"))
    out = keyed.join(first, GROUP_KEY, "inner").drop(GROUP_KEY) \
                 .withColumn(name, F.col("_gidx") - F.col("_first"))
    return out.drop("_pid", "_mid", "_off", "_gidx", "_first")
