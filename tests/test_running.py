"""Running totals over range partitions, point-in-time features, exact ROC AUC."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tackroom.operators.auc import one_vs_rest, roc_auc
from tackroom.operators.running import as_of, totals_before


def data(seed, n, groups, places):
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    return [(pick(groups), pick(places), rng.randrange(5)) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_totals_before_equal_brute_force(spark, partitions):
    rows = data(1, 400, ["hot"] * 9 + ["b", None], [None, *range(25)])
    df = spark.createDataFrame(rows, "g string, t int, x int")
    got = {(r.g, r.t): (r.n, r.s, r.n_before, r.s_before)
           for r in totals_before(df, ["g"], "t", {"n": F.lit(1), "s": F.col("x")}, partitions).collect()}
    low = lambda t: -1 if t is None else t
    want = {}
    for g, t in {(g, t) for g, t, _ in rows}:
        here = [x for a, b, x in rows if (a, b) == (g, t)]
        past = [x for a, b, x in rows if a == g and low(b) < low(t)]
        want[g, t] = (len(here), sum(here), len(past), sum(past))
    assert got == want


def test_as_of_counts_earlier_rows_only(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01", True), (2, "a", "2024-01-01", False), (3, "a", "2024-01-03", True), (4, "a", "2024-01-02", True),
                                (5, None, "2024-01-02", True), (6, "a", None, True), (7, "b", "2024-01-02", False)],
                               "i int, who string, d string, won boolean")
    got = {r.i: (r.runs_before, r.wins_before) for r in as_of(df, "who", "d", {"runs": F.lit(1), "wins": F.col("won").cast("int")}).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (3, 2), 4: (2, 1), 5: (None, None), 6: (None, None), 7: (0, 0)}


def test_auc_equals_all_pairs(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaab"), rng.randrange(8) / 4, rng.random() < 0.4) for _ in range(300)] + [
        ("only", 1.0, True), ("a", None, True), ("a", float("nan"), True), ("a", 1.0, None)]
    got = {r.g: (r.n_pos, r.n_neg, r.auc) for r in roc_auc(spark.createDataFrame(rows, "g string, s double, y boolean"), ["g"], "s", "y").collect()}
    assert got.pop("only") == (1, 0, None)
    for g, (n_pos, n_neg, auc) in got.items():
        known = [(s, y) for a, s, y in rows if a == g and s is not None and not math.isnan(s) and y is not None]
        pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
        wins = sum(2 * (p > n) + (p == n) for p in pos for n in neg)
        assert (n_pos, n_neg) == (len(pos), len(neg)) and auc == pytest.approx(wins / (2 * len(pos) * len(neg)), abs=1e-15)


def test_one_vs_rest_reads_each_class_by_its_place(spark):
    rows = [("x", [0.9, 0.1]), ("y", [0.2, 0.8]), ("x", [0.6, 0.4]), ("y", [0.1, 0.9])]
    df = spark.createDataFrame(rows, "position_class string, scores array<double>")
    assert {r["class"]: r.auc for r in one_vs_rest(df, labels=["x", "y"]).collect()} == {"x": 1.0, "y": 1.0}
    assert {r["class"]: r.auc for r in one_vs_rest(df, labels=["y", "x"]).collect()} == {"x": 0.0, "y": 0.0}
