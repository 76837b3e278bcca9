"""Query of operator 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.registry import query, table
from tackroom.llm.whitening import fit, identity_error, whiten


def components_table(vectors: DataFrame) -> DataFrame:
    """A row for each vector that takes part and component."""
    model = fit(vectors)
    error = identity_error(vectors, model) if model else None
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(x).cast("double") for x in (model.explained if model else [])]).cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                       "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(error).cast("double").alias("identity_error"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: all vectors of ``embeddings`` whitened on their 32 leading components."""
    return components_table(table(spark, sf_dir, "embeddings"))
