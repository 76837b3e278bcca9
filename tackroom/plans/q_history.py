"""Registered queries of point-in-time features and the exact ROC AUC."""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS
from tackroom.operators.auc import one_vs_rest
from tackroom.operators.features import position_class
from tackroom.operators.ml import score, train
from tackroom.operators.running import as_of
from tackroom.plans.registry import query, table


@query("trainer_as_of", "X4", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(h.runs AS BIGINT) AS runs_before, CAST(h.wins AS BIGINT) AS wins_before
FROM lineitem l JOIN (
  SELECT l_suppkey, l_shipdate, coalesce(sum(n) OVER w, 0) AS runs, coalesce(sum(won) OVER w, 0) AS wins
  FROM (SELECT l_suppkey, l_shipdate, count(*) AS n, count_if(l_returnflag = 'R') AS won FROM lineitem GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) h
USING (l_suppkey, l_shipdate)
""")
def trainer_as_of(spark, sf_dir):
    """Every line with what its supplier (the trainer) had shipped and had returned (won) before the line's own day."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    sums = {"runs": F.lit(1), "wins": F.when(F.col("l_returnflag") == "R", 1).otherwise(0)}
    return as_of(li, "l_suppkey", "l_shipdate", sums).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "runs_before", "wins_before")


@query("horse_as_of", "X1 X2", sql="""
SELECT o.o_orderkey, CAST(count(p.o_orderkey) AS BIGINT) AS races_before,
  CASE WHEN count(p.o_orderkey) = 0 THEN 0.0 ELSE count_if(p.o_orderstatus = 'F') / count(p.o_orderkey) END AS win_rate_before
FROM orders o LEFT JOIN orders p ON p.o_custkey = o.o_custkey AND p.o_orderdate < o.o_orderdate
GROUP BY o.o_orderkey
""")
def horse_as_of(spark, sf_dir):
    """Every order (a race of its customer) with the number of the customer's earlier orders and their share that is finished."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    sums = {"races": F.lit(1), "wins": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)}
    rate = F.coalesce(F.try_divide(F.col("wins_before").cast("double"), F.col("races_before").cast("double")), F.lit(0.0))
    return as_of(o, "o_custkey", "o_orderdate", sums).select("o_orderkey", "races_before", rate.alias("win_rate_before"))


SCORES_SQL = """
SELECT CASE WHEN label BETWEEN 1 AND 7 THEN CAST(label AS VARCHAR) ELSE 'other' END AS truth,
  c.class, floor(CAST(embedding[c.place] AS DOUBLE) * 50) AS score FROM embeddings, (VALUES {values}) c(place, class)
""".format(values=", ".join(f"({i + 1}, '{x}')" for i, x in enumerate(CLASS_LABELS)))


@query("exact_auc", "M5", sql=f"""
WITH s AS ({SCORES_SQL}), d AS (
  SELECT class, score, count_if(truth = class) AS pos, count_if(truth <> class) AS neg FROM s GROUP BY class, score),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d)
SELECT class, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)), 9) AS auc FROM r GROUP BY class
""")
def exact_auc(spark, sf_dir):
    """The area of each class against the others, the first eight values of an embedding, in coarse steps, as its scores (so
    that many scores are equal)."""
    e = table(spark, sf_dir, "embeddings")
    coarse = F.transform(F.slice("embedding", 1, 8), lambda x: F.floor(x.cast("double") * 50).cast("double"))
    scored = e.select(position_class(F.col("label")), coarse.alias("scores"))
    return one_vs_rest(scored).select("class", "n_pos", "n_neg", F.round("auc", 9).alias("auc"))


@query("train_learns", "M4 M5 E3", sql="""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN '1' WHEN o_orderkey % 3 = 1 THEN '2' ELSE 'other' END AS class,
  CAST(count(*) AS BIGINT) AS n_pos, CAST((SELECT count(*) FROM orders) - count(*) AS BIGINT) AS n_neg, TRUE AS learned FROM orders GROUP BY 1
""")
def train_learns(spark, sf_dir):
    """A label that two features decide: a model that was trained by the ROC-AUC objective and scores in the right class order ranks
    every class almost perfectly. Scores in another order, or a model that learned nothing, turn this row false."""
    o = table(spark, sf_dir, "orders")
    third = F.col("o_orderkey") % 3
    rows = o.select("o_orderkey", F.when(third == 0, "1").when(third == 1, "2").otherwise("other").alias("position_class"),
                    (F.when(third == 0, 5.0).otherwise(0.0) + F.col("o_totalprice") / F.lit(1e6)).alias("a"),
                    F.when(third == 1, "x").otherwise("y").alias("b"))
    model = train(rows, ["b"], ["a"], model="auto")
    scored = score(rows, model, ["a"], keep=["position_class"])
    return one_vs_rest(scored).where(F.col("n_pos") > 0).select("class", "n_pos", "n_neg", (F.col("auc") > 0.99).alias("learned"))
