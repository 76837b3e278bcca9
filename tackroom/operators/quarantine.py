"""One pass over landed lines to several sinks: records to load, and a quarantine table of what was held back and why.

``split_lines`` classifies every line once and writes all of them partitioned by
status, so that the records to load and the defects are read from their own
folders and nothing is parsed again to tell them apart. ``split_records`` types the
kept records once and writes them in two parts, those that fit their schema and
those with a value that does not. ``hold_back`` gathers the defects of one run, in
the classes malformed, missing_id, beyond_limits and misfit (one row for each
field, nested ones too, with the value it had).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tackroom.constants import BEYOND_LIMITS, MALFORMED, MISFIT, MISSING_ID
from tackroom.functions.records import typed_records
from tackroom.operators.clean import CANDIDATE, classify_lines, group_lines

DEFECTS = (MALFORMED, MISSING_ID, BEYOND_LIMITS)
SCHEMA = "shard string, file_path string, line string, field string, value string, run string, class string"


def split_lines(lines: DataFrame, path: str, order_cols: Sequence[str], keep: str = "first",
                over_limits: str = "separate") -> tuple[DataFrame, DataFrame]:
    """(grouped candidates as ``group_lines`` gives them, all defects): every line is parsed once and written once, under its status."""
    spark = lines.sparkSession
    classified = classify_lines(lines, order_cols, over_limits=over_limits)
    classified.write.mode("errorifexists").partitionBy("status").parquet(path)
    # the folders name the statuses; the schema is given, since a run may have no line at all
    schema = StructType([f for f in classified.schema.fields if f.name != "status"]).add("status", "string")
    stored = spark.read.schema(schema).parquet(path)
    return group_lines(stored.where(F.col("status") == CANDIDATE), order_cols, keep=keep), stored.where(F.col("status").isin(*DEFECTS))


def line_counts(path: str, spark) -> DataFrame:
    """Lines by status of a ``split_lines`` folder (only the folders' row counts are read)."""
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def split_records(kept: DataFrame, schema: StructType | str, path: str, order_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(typed records with their order key, misfits): the records are typed once and written once, those that do not fit in a
    part of their own. ``order_cols`` hold shard and file_path."""
    typed = typed_records(kept, schema, keep=order_cols)
    typed.withColumn("_fits", F.size("_bad") == 0).write.mode("errorifexists").partitionBy("_fits").parquet(path)
    stored = kept.sparkSession.read.schema(typed.schema.add("_fits", "boolean")).parquet(path)
    names = [f.name for f in (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields]
    misfits = stored.where(~F.col("_fits")).select("shard", "file_path", F.col("_line").alias("line"), F.explode("_misfits").alias("m")) \
        .select("shard", "file_path", "line", "m.field", "m.value")
    return stored.where("_fits").select(*order_cols, *[F.col(f"`{n}`") for n in names]), misfits


def hold_back(defects: DataFrame, misfits: DataFrame, quarantine: str, run: str) -> None:
    """Write one run's defects to ``quarantine``, partitioned by run and class. A run that is repeated replaces its own."""
    none = F.lit(None).cast("string")
    rows = defects.select("shard", "file_path", "line", none.alias("field"), none.alias("value"), F.col("status").alias("class")) \
        .unionByName(misfits.withColumn("class", F.lit(MISFIT)))
    (rows.withColumn("run", F.lit(run)).select("shard", "file_path", "line", "field", "value", "run", "class")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "class").parquet(quarantine))


def read_quarantine(spark, quarantine: str) -> DataFrame:
    """What runs held back: shard, file_path, line, field and value (of misfits), run, class."""
    return spark.read.schema(SCHEMA).parquet(quarantine)
