"""tackroom: nested-record ingestion, cleaning, upsert and ranking on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions so Catalyst can prune, push down and code-generate it.
"""

from tackroom.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
