"""Scoring requests, snapshots, staging and the shard ledger."""

import json
import os

from pyspark.sql import functions as F

from tackroom.functions.columns import percent_text
from tackroom.sources.ledger import consume, read_ledger
from tackroom.sources.shards import read_shard_lines, cleaned_name
from tackroom.sources.tables import read_instances, read_snapshot, snapshot_suffix, write_snapshot

SCHEMA = "horse_id string, temperature string, jockey_weight double"


def _dump(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def test_instances_object_bare_and_missing(spark, tmp_dir):
    inst = [{"horse_id": "7", "temperature": "10.0", "jockey_weight": None},
            {"horse_id": "8", "temperature": "x", "jockey_weight": 55.5}]
    _dump(f"{tmp_dir}/obj/req.json", {"instances": inst})
    _dump(f"{tmp_dir}/bare/req.json", inst)
    _dump(f"{tmp_dir}/none/req.json", {"other": 1})
    obj = read_instances(spark, f"{tmp_dir}/obj",
                         "instances array<struct<horse_id:string,temperature:string,jockey_weight:double>>")
    assert [(r.idx, r.horse_id) for r in obj.orderBy("idx").collect()] == [(0, "7"), (1, "8")]
    bare = read_instances(spark, f"{tmp_dir}/bare", SCHEMA)
    assert [(r.idx, r.horse_id, r.jockey_weight) for r in bare.orderBy("idx").collect()] == \
        [(0, "7", None), (1, "8", 55.5)]
    assert read_instances(spark, f"{tmp_dir}/none").count() == 0
    assert read_instances(spark, f"{tmp_dir}/none", SCHEMA).count() == 0
    whole = "instances array<struct<horse_id:string,temperature:string,jockey_weight:double>>"
    assert read_instances(spark, f"{tmp_dir}/bare", whole).count() == 2  # a bare array under the request's schema
    assert read_instances(spark, f"{tmp_dir}/*/", SCHEMA).count() == 4   # both kinds in one read
    two = read_instances(spark, f"{tmp_dir}/*/")                           # inferred; same names, numbered apart
    assert sorted((r.idx, r.horse_id) for r in two.collect()) == [(0, "7"), (0, "7"), (1, "8"), (1, "8")]


def test_snapshot_prunes_to_one_day(spark, tmp_dir):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    write_snapshot(df, tmp_dir, "20240101")
    write_snapshot(df.limit(2), tmp_dir, "20240102")
    write_snapshot(df.limit(3), tmp_dir, "20240102")  # same day rerun replaces only that day
    assert read_snapshot(spark, tmp_dir, "20240101").count() == 5
    assert read_snapshot(spark, tmp_dir, "20240102").count() == 3
    d = spark.range(1).select(snapshot_suffix(F.lit("2024-03-09 23:59:59").cast("timestamp")).alias("d")).first().d
    assert d == "20240309"


def test_ledger_skips_consumed(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for name in ("horse_data_1_to_2_1.ndjson", "horse_data_3_to_4_2.ndjson"):
        with open(f"{src}/{name}", "w") as f:
            f.write('{"id":1}\n')
    ledger = f"{tmp_dir}/ledger"
    lines = read_shard_lines(spark, src)
    assert lines.count() == 2
    consume(lines, ledger)
    with open(f"{src}/horse_data_5_to_6_3.ndjson", "w") as f:
        f.write('{"id":5}\n')
    again = read_shard_lines(spark, src, consumed=read_ledger(spark, ledger))
    assert [r.file_name for r in again.collect()] == ["horse_data_5_to_6_3.ndjson"]


def test_names_and_percent(spark):
    assert cleaned_name("/b/master_x.ndjson", "2024-06-01T10:11:12.123Z") == \
        "/b/master_x_cleaned_deduped_2024-06-01T10_11_12_123Z"
    assert spark.range(1).select(percent_text(F.lit(0.4567)).alias("t")).first().t == "45.7%"


def test_merge_job_nothing_then_merged(spark, tmp_dir):
    from tackroom.plans.flows import merge_job
    src, out, ledger = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    os.makedirs(src)
    r = merge_job(spark, src, out, "m1", ledger=ledger).first()
    assert r.merged_count == 0 and r.status == "nothing_to_merge"
    for name, body in (("horse_data_1001_to_2000_1.ndjson", '{"id":2}'), ("horse_data_1_to_1000_1.ndjson", '{"id":1}')):
        with open(f"{src}/{name}", "w") as f:
            f.write(body)  # no final newline: lines must not glue
    r = merge_job(spark, src, out, "m2", ledger=ledger).first()
    assert (r.merged_count, r.line_count, r.status) == (2, 2, "merged")
    assert [x.value for x in spark.read.text(f"{out}/m2").collect()] == ['{"id":2}', '{"id":1}']
    assert merge_job(spark, src, out, "m3", ledger=ledger).first().status == "nothing_to_merge"


def test_merge_job_removes_after_commit(spark, tmp_dir):
    from tackroom.plans.flows import merge_job
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    os.makedirs(src)
    for name in ("horse_data_1_to_2_1.ndjson", "horse_data_3_to_4_1.ndjson"):
        with open(f"{src}/{name}", "w") as f:
            f.write('{"id":1}\n')
    with open(f"{src}/keep_me.txt", "w") as f:
        f.write("x")
    r = merge_job(spark, src, out, "m", remove_merged=True).first()
    assert (r.merged_count, r.line_count, r.status) == (2, 2, "merged")
    assert sorted(os.listdir(src)) == ["keep_me.txt"]
    assert spark.read.text(f"{out}/m").count() == 2
    assert merge_job(spark, src, out, "m2").first().status == "nothing_to_merge"


def test_request_value_cases(spark, tmp_dir):
    from tackroom.operators.scoring import cast_numeric_fields, cast_string_fields
    from tackroom.constants import NUMERIC_FIELDS, STRING_FIELDS
    inst = [
        {"horse_id": "41", "temperature": "10", "track_distance": "2400.5", "weather": "pochmurno z przejaśnieniami"},
        {"horse_id": "42", "temperature": "ciepło", "track_distance": None, "weather": "słońce"},
        {"horse_id": "43", "weather": "deszcz"},  # absent numeric fields
    ]
    _dump(f"{tmp_dir}/req/r.json", {"instances": inst})
    req = read_instances(spark, f"{tmp_dir}/req",
                         "instances array<struct<horse_id:string,temperature:string,track_distance:string,weather:string>>")
    out = cast_numeric_fields(cast_string_fields(req, STRING_FIELDS), NUMERIC_FIELDS).orderBy("idx").collect()
    assert [(r.temperature, r.temperature_raw) for r in out] == [(10.0, None), (None, "ciepło"), (None, None)]
    assert [r.track_distance for r in out] == [2400.5, None, None]
    assert out[0].weather == "pochmurno z przejaśnieniami" and out[1].horse_id == "42"
