"""Landings with a manifest, and schemas found in lines."""

import pytest
from pyspark.sql import functions as F

from tackroom.functions.inference import infer_types, load_inferred
from tackroom.plans.flows import merge_clean_upsert
from tackroom.sources.landing import land, landed_files, list_landed, read_landed
from tackroom.sources.merge_on_read import read_merged


def test_files_of_one_folder_named_by_the_manifest(spark, tmp_dir):
    root = f"{tmp_dir}/l"
    rows = spark.range(1, 251).select("id", F.lit(None).cast("string").alias("v"))
    land(rows, root, "id", 0, 100, 7, "a")
    got = landed_files(spark, root).orderBy("min_id").collect()
    assert [(r.shard, r.n_lines, r.min_id, r.max_id, r.landing) for r in got] == [
        ("horse_data_0_to_99_7.ndjson", 99, 1, 99, "a"), ("horse_data_100_to_199_7.ndjson", 100, 100, 199, "a"),
        ("horse_data_200_to_299_7.ndjson", 51, 200, 250, "a")]
    lines = read_landed(spark, root, 150, 160)
    assert len(lines.inputFiles()) == 1 and lines.count() == 100
    assert lines.orderBy("block_start", "row_id").first().line == '{"id":100,"v":null}'
    land(rows.where("id < 50"), root, "id", 0, 100, 8, "b")
    land(rows.where("id < 30"), root, "id", 0, 100, 8, "b")     # a repeated landing replaces itself
    assert read_landed(spark, root).count() == 279 and list_landed(spark, root).count() == 4
    with pytest.raises(Exception, match="out of range"):
        land(spark.createDataFrame([(None,)], "id long"), root, "id", 0, 100, 9, "c")
    assert read_landed(spark, root).count() == 279 and read_landed(spark, f"{tmp_dir}/none").count() == 0


def test_a_batch_with_most_rows_is_dealt_over_files(spark, tmp_dir):
    root = f"{tmp_dir}/l"
    rows = spark.range(4000).select(F.when(F.col("id") < 3900, F.lit(5)).otherwise(F.col("id")).alias("id"), F.col("id").alias("n"))
    land(rows, root, "id", 0, 100, 7, "a", max_lines=1000)
    files = landed_files(spark, root).collect()
    hot = [f.n_lines for f in files if f.max_id == 5]
    assert len(hot) == 4 and sum(hot) == 3900 and max(hot) < 1200 and sum(f.n_lines for f in files) == 4000


def test_ingest_from_a_manifest(spark, tmp_dir):
    root, target, ledger = f"{tmp_dir}/l", f"{tmp_dir}/t", f"{tmp_dir}/ledger"
    opts = {"layout": "manifest", "ledger": ledger, "merge_on_read": True, "compact_after": 1}
    lines = lambda *x: spark.createDataFrame([(i, t) for i, t in enumerate(x, 1)], "k long, line string")
    land(lines('{"id":1,"v":"a"}', "junk", '{"id":2,"v":"b"}'), root, "k", 0, 10, 7, "a", line_col="line")
    r = merge_clean_upsert(spark, root, target, "id long, v string", "id", "2024-01-01 00:00:00", **opts).first()
    assert (r.rows_source, r.rows_after, r.balanced) == (2, 2, True)
    land(lines('{"id":2,"v":"c"}', '{"id":3,"v":"d"}'), root, "k", 0, 10, 8, "b", line_col="line")
    r = merge_clean_upsert(spark, root, target, "id long, v string", "id", "2024-01-02 00:00:00", **opts).first()
    assert (r.rows_source, r.rows_before, r.rows_replaced, r.rows_inserted, r.rows_after, r.balanced) == (2, 2, 1, 1, 3, True)
    assert sorted((x.id, x.v) for x in read_merged(spark, target, "id").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_types_meet_in_the_lattice(spark):
    df = spark.createDataFrame([(x,) for x in (
        '{"a":1,"b":1,"c":true,"d":{"x":1},"e":[1],"f":null,"g h":5.0,"i":1e3}', "\t", "", ' ',
        '{"a":2.5,"b":"0x","c":1,"d":{"y":"t"},"e":"no","f":null,"g h":7,"i":"1e3"}', '{"a":null,"b":1e2}')], "line string")
    got = {r.field: (r.type, r.seen, r.changed) for r in infer_types(df).collect()}
    assert got == {"a": ("double", "null, number, whole", True), "b": ("string", "text, whole", True), "c": ("string", "boolean, whole", True),
                   "d": ("struct<x: bigint, y: string>", "nested", False), "e": ("string", "nested, text", True), "f": ("string", "null", False),
                   "g h": ("bigint", "whole", False), "i": ("string", "text, whole", True)}
    assert {r.n_lines for r in infer_types(df).collect()} == {3}


def test_a_line_that_is_no_object_is_a_misfit(spark, tmp_dir):
    df = spark.createDataFrame([('{"a":1}',), ("[1]",), ("x",), ('{"a":"1"}',)], "line string")
    with pytest.raises(Exception, match="does not fit"):
        load_inferred(df).collect()
    assert sorted(r.a for r in load_inferred(df, rejects=f"{tmp_dir}/r").collect()) == ["1", "1"]
    assert sorted(r.line for r in spark.read.parquet(f"{tmp_dir}/r").collect()) == ["[1]", "x"]
    assert load_inferred(df.limit(0)).count() == 0
