"""Scoring: class map, rank scaling, greedy top-K against a brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS
from tackroom.operators.scoring import (
    cast_numeric_fields, cast_string_fields, class_probs, greedy_top_k, relative_rank, win_place_top3,
)


def greedy_ref(rows, k):
    """rows: list of (idx, scores). Plain statement of the greedy rule."""
    chosen, picks = set(), []
    ordered = sorted(rows)
    for pos in range(1, min(k, len(rows)) + 1):
        best, best_p = None, -1.0
        for idx, sc in ordered:
            if idx in chosen:
                continue
            p = sc[pos - 1] if pos <= 7 else 0.0  # label str(pos); "8" is not a class
            if p > best_p:
                best, best_p = idx, p
        chosen.add(best)
        picks.append((pos, best, best_p))
    return picks


@pytest.mark.parametrize("k", [1, 3, 7, 10])
def test_greedy_matches_brute_force(spark, k):
    rnd = random.Random(k)
    data = []
    for g in range(25):
        n = rnd.choice([1, 2, 5, 9, 30])
        for i in range(n):
            # coarse values force many ties
            data.append((g, i * 3 + 1, [round(rnd.choice([0.1, 0.2, 0.3, rnd.random()]), 2) for _ in range(8)]))
    df = spark.createDataFrame(data, "g int, idx long, scores array<double>") \
              .withColumn("probs", class_probs(F.col("scores")))
    got = sorted((r.g, r.position, r.idx, r.prob) for r in greedy_top_k(df, "probs", "idx", ["g"], k).collect())
    exp = []
    for g in range(25):
        rows = [(i, s) for gg, i, s in data if gg == g]
        exp += [(g, p, i, pr) for p, i, pr in greedy_ref(rows, k)]
    assert got == sorted(exp)


def test_greedy_moves_each_row_once_and_large_groups_agree(spark, tmp_dir):
    rnd = random.Random(3)
    data = [(g, i, [rnd.choice([0.1, 0.2, rnd.random()]) for _ in range(8)]) for g in [None, 1, 2, 3] for i in range(1 + 9 * (g or 0))]
    spark.createDataFrame(data, "g int, idx long, scores array<double>").write.parquet(f"{tmp_dir}/rows")
    df = spark.read.parquet(f"{tmp_dir}/rows").withColumn("probs", class_probs(F.col("scores")))
    exp = sorted((str(g), p, i, pr) for g in [None, 1, 2, 3] for p, i, pr in greedy_ref([(i, s) for gg, i, s in data if gg == g], 7))
    for max_rows in (1, 10, 1000):  # all but one group, two groups, and no group too large for an array
        out = greedy_top_k(df, "probs", "idx", ["g"], 7, max_rows)
        assert sorted((str(r.g), r.position, r.idx, r.prob) for r in out.collect()) == exp
    plan = greedy_top_k(df, "probs", "idx", ["g"], 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_greedy_ungrouped_and_distinct(spark):
    df = spark.createDataFrame([(i, [1.0 / (i + 1)] * 8) for i in range(12)], "idx long, scores array<double>") \
              .withColumn("probs", class_probs(F.col("scores")))
    out = greedy_top_k(df, "probs", "idx", [], 7).collect()
    assert len(out) == 7 and len({r.idx for r in out}) == 7
    assert [r.idx for r in sorted(out, key=lambda r: r.position)] == list(range(7))


def test_relative_rank_half_even_and_equal(spark):
    # p chosen so the scaled values are exactly 50.5 and 51.5
    rows = [("a", 1, 0.0), ("a", 2, 49.5), ("a", 3, 50.5), ("a", 4, 99.0), ("b", 5, 0.3), ("b", 6, 0.3)]
    df = spark.createDataFrame(rows, "g string, idx long, p double")
    out = {r.idx: r.rel_rank for r in relative_rank(df, "p", ["g"]).collect()}
    assert out == {1: 1, 2: 50, 3: 52, 4: 100, 5: 100, 6: 100}
    whole = {r.idx: r.rel_rank for r in relative_rank(df, "p").collect()}
    assert whole[1] == 1 and whole[4] == 100 and all(1 <= v <= 100 for v in whole.values())


def test_class_probs_and_cumulative(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.3, 0.1, 0.1, 0.1, 0.05, 0.05],)], "scores array<double>")
    r = win_place_top3(df.withColumn("class_probs", class_probs(F.col("scores")))).first()
    assert set(r.class_probs) == set(CLASS_LABELS)
    assert r.win_prob == 0.1 and abs(r.place_prob - 0.3) < 1e-12 and abs(r.top3_prob - 0.6) < 1e-12


def test_fewer_than_eight_scores_fails(spark):
    df = spark.createDataFrame([([0.5, 0.5],)], "scores array<double>")
    with pytest.raises(Exception):
        df.select(class_probs(F.col("scores"))).collect()


def test_casts(spark):
    df = spark.createDataFrame([(41910, "2400", " 10.5 ", "abc", None)],
                               "horse_id long, track_distance string, temperature string, jockey_weight string, career_prize string")
    out = cast_numeric_fields(cast_string_fields(df, ["horse_id"]),
                              ["track_distance", "temperature", "jockey_weight", "career_prize"]).first()
    assert out.horse_id == "41910" and out.track_distance == 2400.0 and out.temperature == 10.5
    assert out.jockey_weight is None and out.jockey_weight_raw == "abc"
    assert out.career_prize is None and out.career_prize_raw is None


def test_null_group_is_a_group(spark):
    rows = [(None, 1, [0.5] + [0.0] * 7), (None, 2, [0.1] + [0.0] * 7), ("a", 3, [0.2] * 8)]
    df = spark.createDataFrame(rows, "g string, idx long, scores array<double>") \
              .withColumn("probs", class_probs(F.col("scores")))
    rr = {r.idx: r.rel_rank for r in relative_rank(win_place_top3(df, "probs"), "win_prob", ["g"]).collect()}
    assert rr == {1: 100, 2: 1, 3: 100}
    picks = sorted((r.g or "-", r.position, r.idx) for r in greedy_top_k(df, "probs", "idx", ["g"], 2).collect())
    assert picks == [("-", 1, 1), ("-", 2, 2), ("a", 1, 3)]


def test_casts_follow_python(spark):
    from tackroom.operators.scoring import python_float, python_text
    numbers = [0.0, 1.5, 1e7, 12345678.9, 1e16, 1.5e16, 1e15, 1e-4, 1e-5, -2.5e-7, 1e100, 123456789012345.0, float("inf"), -1e22, 0.001]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", python_text(F.col("x"), "double").alias("t")).collect()
    assert [r.t for r in rows] == [str(r.x) for r in rows]
    assert [r[0] for r in spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
            .select(python_text(F.col("b"), "boolean")).collect()] == ["True", "False", None]
    texts = ["5d", "5f", "1_000", "1__0", "_1", " 7.5 ", ".5", "5.", "1e5", "1_0e1_0", "inf", "-Infinity", "nan", "", "0x10", "1e", "+3"]

    def python(t):
        try:
            return str(float(t))
        except ValueError:
            return None
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", python_float(F.col("t")).alias("v")).collect()
    assert [None if r.v is None else str(r.v) for r in got] == [python(r.t) for r in got]
