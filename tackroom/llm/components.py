"""Connected components of an edge table, by contracting trees of smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize


def _roots(parent: DataFrame) -> DataFrame:
    """Pointer jumping (u, p) with p <= u until every p is a root."""
    while True:
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        jumped = materialize(parent.join(up, "p", "left")
                             .select("u", F.coalesce("pp", "p").alias("q"), F.col("p").alias("old")), "jump")
        parent = jumped.select("u", F.col("q").alias("p"))
        if jumped.where("q <> old").limit(1).count() == 0:
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (id, component): the smallest id reachable, one row per id that has an edge.

    Each round every node points at its smallest neighbour if that is smaller,
    pointer jumping turns the resulting trees into stars, and the edges are
    rewritten between roots. At least half the roots with an edge go each
    round, so the rounds grow with the logarithm of the largest component. All
    state is in tables on shared storage; the driver reads one row per round.
    Self-loops and repeated edges do no harm; an empty edge table gives no rows.
    """
    edges = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                        .where("a <> b").distinct(), "edges")
    mapping = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        parent = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                             .select("u", F.least("u", "m").alias("p")), "parent")
        parent = _roots(parent)
        if mapping is None:
            mapping = parent.select(F.col("u").alias("id"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("u").alias("component"), F.col("p").alias("to"))
            mapping = materialize(mapping.join(step, "component", "left")
                                  .select("id", F.coalesce("to", "component").alias("component")), "mapping")
        pa_ = parent.select(F.col("u").alias("a"), F.col("p").alias("ra"))
        pb = parent.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        edges = materialize(edges.join(pa_, "a").join(pb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                            .where("a <> b").distinct(), "edges")
        if edges.limit(1).count() == 0:
            return mapping
