"""The merge -> clean -> upsert flow on the profile record model (invented rows)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tackroom.operators.reshape import map_career, map_races
from tackroom.plans.flows import merge_clean_upsert
from tackroom.schemas import STAGING_SCHEMA
from tackroom.sources.tables import read_target


def profile(i, name, prize="100 + 50", distance="2400"):
    return {
        "id": i, "name": name, "gender": "MARE", "color": None, "mother": "M", "motherId": 7,
        "father": None, "fatherId": None, "trainer": "T", "breed": "B", "breeder": None, "owner": "O",
        "dateOfBirth": "2019-04-01",
        "career": [{"raceYear": 2021, "prize": prize, "horseAge": 2, "raceType": "flat", "raceCount": 3,
                    "raceWonCount": 1, "racePrizeCount": 2}],
        "races": [{"horseOrder": 1, "horseFinalPlace": 2, "prizeAmount": 500, "prizeCurrency": "PLN",
                   "jockeyFirstName": "J", "jockeyLastName": "K", "jockeyWeight": 55.5,
                   "trackDistance": distance, "temperature": 12, "weather": "sun", "raceGroup": "G",
                   "raceSubtype": "S", "raceCategoryName": "C", "cityName": "W", "trackTypeName": "turf"}],
    }


def reshape(df):
    return df.withColumn("career", map_career(F.col("career"))).withColumn("races", map_races(F.col("races")))


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines))


def test_profiles_flow_twice(spark, tmp_dir):
    src, target, ledger = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ledger"
    os.makedirs(src)
    write(f"{src}/horse_data_1_to_1000_1.ndjson",
          [json.dumps(profile(1, "A")), "", json.dumps(profile(2, "B")), '{"id":3,', json.dumps(profile(1, "A2"))])
    rep = merge_clean_upsert(spark, src, target, STAGING_SCHEMA, "id", "2024-01-01 00:00:00",
                             ledger=ledger, reshape=reshape, buckets=2).first()
    assert (rep.rows_before, rep.rows_source, rep.rows_after, rep.balanced) == (0, 2, 2, True)
    rows = {r.id: r for r in read_target(spark, target, key="id", buckets=2).collect()}
    assert rows[1].name == "A"  # first wins inside a run
    c, r = rows[1].career[0], rows[1].races[0]
    assert (c.raceName, c.otherDetails, c.prize) == ("", "", "100 + 50")
    assert r.trackDistance == 2400.0 and r.temperature == 12.0 and r.prizeAmount == "500"

    write(f"{src}/horse_data_1_to_1000_2.ndjson", [json.dumps(profile(2, "B2")), json.dumps(profile(4, "D"))])
    rep = merge_clean_upsert(spark, src, target, STAGING_SCHEMA, "id", "2024-01-02 00:00:00",
                             ledger=ledger, reshape=reshape, buckets=2).first()
    assert (rep.rows_before, rep.rows_source, rep.rows_matched, rep.rows_after) == (2, 2, 1, 3)
    rows = {r.id: (r.name, str(r.updated_at)) for r in read_target(spark, target, key="id", buckets=2).collect()}
    assert rows == {1: ("A", "2024-01-01 00:00:00"), 2: ("B2", "2024-01-02 00:00:00"),
                    4: ("D", "2024-01-02 00:00:00")}


def test_uncastable_distance_fails(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    write(f"{src}/horse_data_1_to_1000_1.ndjson", [json.dumps(profile(1, "A", distance="far"))])
    with pytest.raises(Exception):
        merge_clean_upsert(spark, src, f"{tmp_dir}/t", STAGING_SCHEMA, "id", "2024-01-01 00:00:00",
                           reshape=reshape)


def test_profiles_flow_ranged(spark, tmp_dir):
    from tackroom.sources.tables import read_ranged
    src, target, ledger = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ledger"
    os.makedirs(src)
    write(f"{src}/horse_data_1_to_1000_1.ndjson", [json.dumps(profile(1, "A")), json.dumps(profile(2, "B"))])
    rep = merge_clean_upsert(spark, src, target, STAGING_SCHEMA, "id", "2024-01-01 00:00:00",
                             ledger=ledger, reshape=reshape, range_width=1000).first()
    assert (rep.rows_before, rep.rows_after, rep.balanced) == (0, 2, True)
    write(f"{src}/horse_data_1001_to_2000_2.ndjson", [json.dumps(profile(2, "B2")), json.dumps(profile(1500, "C"))])
    rep = merge_clean_upsert(spark, src, target, STAGING_SCHEMA, "id", "2024-01-02 00:00:00",
                             ledger=ledger, reshape=reshape, range_width=1000).first()
    assert (rep.rows_before, rep.rows_matched, rep.rows_after, rep.balanced) == (2, 1, 3, True)
    assert sorted((r.id, r.name) for r in read_ranged(spark, target).collect()) == [(1, "A"), (2, "B2"), (1500, "C")]
