"""Feature derivation, including the optional as-of cut."""

from pyspark.sql import functions as F

from tackroom.operators.features import (
    birth_year, career_totals, jockey_weight_missing, position_class, trainer_stats,
)

CAREER = "array<struct<raceYear:int,prize:string,raceCount:int,raceWonCount:int,racePrizeCount:int>>"


def test_career_totals_and_as_of(spark):
    df = spark.createDataFrame([(1, [(2020, "100 + 50", 4, 1, 2), (2021, "7", 3, 3, 0)]), (2, []), (3, None)],
                               f"id int, career {CAREER}")
    out = {r.id: r for r in career_totals(df).collect()}
    a = out[1]
    assert (a.total_races, a.total_wins, a.total_prize_count) == (7, 4, 2)
    assert abs(a.career_win_rate - 4 / 7) < 1e-12 and a.career_prize == 157.0
    assert (out[2].total_races, out[2].career_win_rate, out[2].career_prize) == (0, 0.0, 0.0)
    assert out[3].total_races == 0
    cut = {r.id: r for r in career_totals(df, as_of_year=2021).collect()}
    assert (cut[1].total_races, cut[1].total_wins, cut[1].career_prize) == (4, 1, 150.0)
    per_row = career_totals(df.withColumn("y", F.lit(2020)), as_of_year=F.col("y")).collect()
    assert {r.id: r.total_races for r in per_row}[1] == 0


def test_trainer_stats_as_of(spark):
    rows = spark.createDataFrame([("T", True, "2024-01-01"), ("T", False, "2024-02-01"), ("U", True, "2024-03-01")],
                                 "t string, won boolean, d string").withColumn("d", F.col("d").cast("timestamp"))
    full = {r.t: (r.trainer_freq, r.trainer_win_rate) for r in trainer_stats(rows, "t", F.col("won")).collect()}
    assert full == {"T": (2, 0.5), "U": (1, 1.0)}
    cut = {r.t: (r.trainer_freq, r.trainer_win_rate)
           for r in trainer_stats(rows, "t", F.col("won"), when=F.col("d"), as_of="2024-02-01").collect()}
    assert cut == {"T": (1, 1.0)}


def test_small_features(spark):
    df = spark.createDataFrame([("2019-05-06", None, 3), ("bad", 55.0, 9), (None, 1.0, 7)],
                               "dob string, w double, place int")
    out = df.select(birth_year(F.col("dob")).alias("y"), jockey_weight_missing(F.col("w")).alias("m"),
                    position_class(F.col("place"))).collect()
    assert [(r.y, r.m, r.position_class) for r in out] == [(2019, "1", "3"), (None, "0", "other"), (None, "0", "7")]
