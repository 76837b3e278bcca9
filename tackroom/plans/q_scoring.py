"""Registered queries for scoring, ranking and features."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tackroom.constants import DEFAULT_TOP_K, NUMERIC_FIELDS, STRING_FIELDS
from tackroom.operators.features import (
    birth_year, jockey_weight_missing, position_class, trainer_stats,
)
from tackroom.operators.scoring import (
    cast_numeric_fields, cast_string_fields, class_probs, finishers, greedy_top_k, race_card,
    relative_rank, win_place_top3,
)
from tackroom.plans.registry import query, table
from tackroom.session import scratch_dir
from tackroom.sources.tables import read_instances


N_VALUES, N_CLASSES = 64, 8  # values of an embedding; class i takes the values i, i + 8, i + 16, ...


def folded_values(embedding: str = "embedding"):
    """Eight sums that together hold every value of an embedding."""
    values = [[F.get(embedding, F.lit(j)).cast("double") for j in range(i, N_VALUES, N_CLASSES)] for i in range(N_CLASSES)]
    return [functools.reduce(lambda a, b: a + b, v) for v in values]


def scored(spark, sf_dir):
    """Eight class scores per embedding: softmax over sums of all its values,
    rounded to 9 decimals. ``label`` plays the race, ``vec_id`` the index."""
    e = table(spark, sf_dir, "embeddings")
    df = e.select("label", "vec_id", F.array(*[F.exp(v) for v in folded_values()]).alias("_ex"))
    total = F.aggregate(F.col("_ex"), F.lit(0.0), lambda a, x: a + x)
    return df.select("label", "vec_id", F.transform("_ex", lambda x: F.round(x / total, 9)).alias("scores"))


_EX = ", ".join("exp(" + " + ".join(f"CAST(embedding[{j + 1}] AS DOUBLE)" for j in range(i, N_VALUES, N_CLASSES)) + ")"
                for i in range(N_CLASSES))
SCORED_SQL = f"""
  SELECT label, vec_id,
    list_transform(ex, lambda x: round(x / list_reduce(ex, lambda a, b: a + b), 9)) AS scores
  FROM (SELECT label, vec_id, [{_EX}] AS ex FROM embeddings)
"""

PROBS_SQL = f"""
  SELECT label, vec_id, scores[1] AS s1, scores[2] AS s2, scores[3] AS s3, scores[4] AS s4,
    scores[5] AS s5, scores[6] AS s6, scores[7] AS s7, scores[8] AS s8,
    scores[1] AS win_prob, scores[1] + scores[2] AS place_prob, scores[1] + scores[2] + scores[3] AS top3_prob
  FROM ({SCORED_SQL})
"""


@query("win_place_top3", "M1 M2 F9 F10", sql=f"""
SELECT label, vec_id, win_prob, place_prob, top3_prob FROM ({PROBS_SQL})
""")
def win_place_top3_q(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("class_probs", class_probs(F.col("scores")))
    return win_place_top3(df).select("label", "vec_id", "win_prob", "place_prob", "top3_prob")


RANK_SQL = f"""
  SELECT label, vec_id, win_prob, place_prob, top3_prob,
    CASE WHEN mx = mn THEN 100 ELSE CAST(round_even(1 + (win_prob - mn) * 99 / (mx - mn), 0) AS INTEGER) END AS rel_rank
  FROM (SELECT *, min(win_prob) OVER (PARTITION BY label) AS mn, max(win_prob) OVER (PARTITION BY label) AS mx
        FROM ({PROBS_SQL}))
"""


@query("relative_rank", "W1 F11", sql=f"SELECT label, vec_id, rel_rank FROM ({RANK_SQL})")
def relative_rank_q(spark, sf_dir):
    df = win_place_top3(scored(spark, sf_dir).withColumn("class_probs", class_probs(F.col("scores"))))
    return relative_rank(df, "win_prob", ["label"]).select("label", "vec_id", "rel_rank")


@query("race_card", "M3", sql=f"SELECT label, vec_id, vec_id + 1 AS number, win_prob, place_prob, top3_prob, rel_rank FROM ({RANK_SQL})")
def race_card_q(spark, sf_dir):
    return race_card(scored(spark, sf_dir), "scores", "vec_id", ["label"]).select(
        "label", "vec_id", "number", "win_prob", "place_prob", "top3_prob", "rel_rank")


def greedy_sql(k: int = DEFAULT_TOP_K) -> str:
    """Unrolled greedy picks: step p takes the best remaining row by P(p)."""
    ctes = [f"probs AS ({PROBS_SQL})"]
    for p in range(1, k + 1):
        col = f"s{p}" if p <= 8 else "0.0"
        excl = " ".join(f"AND NOT EXISTS (SELECT 1 FROM p{q} WHERE p{q}.label = s.label AND p{q}.vec_id = s.vec_id)"
                        for q in range(1, p))
        ctes.append(f"""p{p} AS (SELECT label, vec_id, prob FROM (
            SELECT s.label, s.vec_id, {col} AS prob,
              row_number() OVER (PARTITION BY s.label ORDER BY {col} DESC, s.vec_id) AS rn
            FROM probs s WHERE TRUE {excl}) WHERE rn = 1)""")
    unions = " UNION ALL ".join(f"SELECT label, {p} AS position, vec_id, prob FROM p{p}" for p in range(1, k + 1))
    return "WITH " + ",\n".join(ctes) + "\n" + unions


@query("greedy_top_k", "W2", sql=greedy_sql())
def greedy_top_k_q(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("class_probs", class_probs(F.col("scores")))
    return greedy_top_k(df, "class_probs", "vec_id", ["label"], DEFAULT_TOP_K)


@query("predicted_finishers", "M3 W2", sql=f"SELECT label, position, vec_id + 1 AS number, prob FROM ({greedy_sql()})")
def predicted_finishers_q(spark, sf_dir):
    return finishers(scored(spark, sf_dir), "scores", "vec_id", ["label"]).select("label", "position", "number", "prob")


@query("trainer_stats", "X4", sql="""
SELECT s_suppkey, s_name, CAST(count(*) AS BIGINT) AS trainer_freq,
  round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS trainer_win_rate
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name
""")
def trainer_stats_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    st = trainer_stats(li, "l_suppkey", F.col("l_returnflag") == "R")
    return st.join(s, st.l_suppkey == s.s_suppkey).select(
        "s_suppkey", "s_name", "trainer_freq", F.round("trainer_win_rate", 6).alias("trainer_win_rate"))


@query("feature_rows", "X5 X6 X7 X8", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(year(o_orderdate) AS INTEGER) AS birth_year,
  CASE WHEN nullif(l_tax, 0) IS NULL THEN '1' ELSE '0' END AS jockey_weight_missing,
  nullif(l_tax, 0) AS jockey_weight, l_quantity AS track_distance,
  CASE WHEN l_linenumber BETWEEN 1 AND 7 THEN CAST(l_linenumber AS VARCHAR) ELSE 'other' END AS position_class
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def feature_rows_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", spread=True)
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dob"))
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    w = F.nullif(F.col("l_tax"), F.lit(0.0))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    birth_year(F.col("dob")).alias("birth_year"),
                    jockey_weight_missing(w).alias("jockey_weight_missing"),
                    w.alias("jockey_weight"), F.col("l_quantity").alias("track_distance"),
                    position_class(F.col("l_linenumber")))


@query("cast_instances", "S11 P10 P11", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS horse_id, CAST(p_size AS VARCHAR) AS total_races,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS career_prize,
  CASE WHEN p_partkey % 11 = 0 THEN 'n/a' END AS career_prize_raw,
  CAST(p_size AS DOUBLE) AS track_distance, CAST(NULL AS VARCHAR) AS track_distance_raw,
  p_brand AS breed, p_type AS race_group
FROM part
""")
def cast_instances_q(spark, sf_dir):
    """``part`` rendered as scoring requests (one ``{"instances":[...]}`` file
    per 1,000 part keys, so each request document stays bounded), read back
    and normalised. Every 11th price is unparseable text."""
    part = table(spark, sf_dir, "part")
    inst = F.struct(
        F.col("p_partkey").alias("horse_id"), F.col("p_size").alias("total_races"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit("n/a"))
         .otherwise(F.col("p_retailprice").cast("string")).alias("career_prize"),
        F.col("p_size").cast("string").alias("track_distance"),
        F.col("p_brand").alias("breed"), F.col("p_type").alias("race_group"))
    batch = F.floor(F.col("p_partkey") / 1000)
    ordered = F.sort_array(F.collect_list(F.struct(F.col("p_partkey").alias("_k"), inst.alias("i"))))
    docs = part.groupBy(batch.alias("batch")).agg(
        F.to_json(F.struct(F.transform(ordered, lambda e: e["i"]).alias("instances"))).alias("value"))
    out = scratch_dir(spark, "instances")
    # one document per file: a multi-line JSON file holds exactly one value
    docs.repartition("batch").write.mode("errorifexists").partitionBy("batch").text(out)
    schema = ("instances array<struct<horse_id:long,total_races:long,career_prize:string,"
              "track_distance:string,breed:string,race_group:string>>")
    req = read_instances(spark, out, schema)
    norm = cast_numeric_fields(cast_string_fields(req, STRING_FIELDS), NUMERIC_FIELDS)
    return norm.select("horse_id", "total_races", "career_prize", "career_prize_raw",
                       "track_distance", "track_distance_raw", "breed", "race_group")
