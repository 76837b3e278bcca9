"""Running totals per group without a task that holds a group.

``totals_before`` gives every place in a group's order the sums over all earlier
places. Rows are first added up per (group, place), which also shrinks a hot place.
The places are then range-partitioned on (group, place), so that a busy group
lies over several tasks; each task sums its own part, and what the parts before it
carry over comes from one small row for each part and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tackroom.functions.columns import GROUP_KEY, with_group_key
from tackroom.session import scratch_dir


def totals_before(rows: DataFrame, group_cols: Sequence[str], place: str, sums: dict[str, Column],
                  partitions: int | None = None) -> DataFrame:
    """(group columns, ``place``, and for each name of ``sums``: the name, its sum at the place, and ``<name>_before``, its sum
    over the group's earlier places). A NULL group is a group; a NULL place comes first. Sums are never NULL."""
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = with_group_key(rows, group_cols).groupBy(GROUP_KEY, place).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()])
    path = scratch_dir(spark, "running-totals")
    # written once: two readings of a range partitioning could cut it at other sampled bounds
    places.repartitionByRange(n, GROUP_KEY, place).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    inner = Window.partitionBy("_part", GROUP_KEY).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = stored.select("*", *[F.coalesce(F.sum(name).over(inner), F.lit(0)).alias(f"_{name}") for name in sums])
    outer = Window.partitionBy(GROUP_KEY).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("_part", GROUP_KEY).agg(*[F.sum(name).alias(name) for name in sums])
    carried = parts.select("_part", GROUP_KEY, *[F.coalesce(F.sum(name).over(outer), F.lit(0)).alias(f"_carry_{name}") for name in sums])
    return local.join(carried, ["_part", GROUP_KEY]).select(
        *[F.col(f"{GROUP_KEY}.{c}").alias(c) for c in group_cols], place, *sums,
        *[(F.col(f"_{name}") + F.col(f"_carry_{name}")).alias(f"{name}_before") for name in sums])


def as_of(rows: DataFrame, group: str, when: str, sums: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """Point-in-time features (X1, X4): every row with ``<name>_before``, the sum over its group's rows of an earlier ``when``.
    Rows of the same time do not count for each other. A NULL group has no history that could be its own, and a
    NULL time none that could be earlier: both get NULL."""
    known = rows.where(F.col(group).isNotNull() & F.col(when).isNotNull())
    totals = totals_before(known, [group], when, sums, partitions).select(group, when, *[f"{name}_before" for name in sums])
    return rows.join(totals, [group, when], "left").select(*rows.columns, *[f"{name}_before" for name in sums])
