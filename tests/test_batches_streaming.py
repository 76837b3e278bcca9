"""Id batches, missing ids, outcomes, shard writing and the incremental mode."""

import os

import pytest
from pyspark.sql import functions as F

from tackroom.operators.batches import batch_of, batch_outcomes, id_batches, missing_ids
from tackroom.sources.shards import list_shards, merge_summary, read_shard_lines, write_batch_shards, write_line_shards
from tackroom.streaming.incremental import incremental_shards, incremental_upsert, shard_stream
from tackroom.sources.tables import read_target


def test_id_batches(spark):
    b = id_batches(spark, 1, 1000, 3)
    rows = b.groupBy("batch").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("batch").collect()
    assert [(r.batch, r.lo, r.hi) for r in rows] == [(1, 1, 1000), (2, 1001, 2000), (3, 2001, 3000)]
    with pytest.raises(ValueError):
        id_batches(spark, 0, 10, 1)


def test_missing_ids_and_outcomes(spark):
    b = id_batches(spark, 1, 5, 2)
    rec = spark.createDataFrame([(1,), (4,), (9,), (None,)], "id long")
    assert sorted(r.id for r in missing_ids(b, rec).collect()) == [2, 3, 5, 6, 7, 8, 10]
    df = spark.createDataFrame([(1, "found"), (2, "error"), (7, "found")], "id long, o string")
    out = sorted(tuple(r) for r in batch_outcomes(df, batch_of(F.col("id"), 1, 5), F.col("o")).collect())
    assert out == [(1, "error", 1), (1, "found", 1), (2, "found", 1)]


def test_write_and_read_batch_shards(spark, tmp_dir):
    df = spark.range(0, 250).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("x"))
    write_batch_shards(df, tmp_dir, "k", 0, 100, 42)
    lines = read_shard_lines(spark, tmp_dir, layout="partitioned")
    names = sorted(r.shard for r in lines.select("shard").distinct().collect())
    assert names == ["horse_data_0_to_99_42.ndjson", "horse_data_100_to_199_42.ndjson",
                     "horse_data_200_to_299_42.ndjson"]
    assert '"x":null' in lines.first().line  # nulls are written, not omitted
    s = merge_summary(list_shards(spark, tmp_dir, layout="partitioned"), lines, "m").first()
    assert s.merged_count == 3 and s.line_count == 250
    write_batch_shards(df, tmp_dir, "k", 0, 100, 42)  # a retried landing replaces, never duplicates
    write_batch_shards(df.where("k < 100"), tmp_dir, "k", 0, 100, 43)  # a new stamp adds a shard
    again = read_shard_lines(spark, tmp_dir, layout="partitioned")
    assert again.count() == 350 and again.select("shard").distinct().count() == 4


def test_incremental_consumes_only_new(spark, tmp_dir):
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    with open(f"{src}/horse_data_1_to_2_1.ndjson", "w") as f:
        f.write('{"id":1}\n{"id":2}\n')
    incremental_shards(shard_stream(spark, src), sink, ckpt)
    with open(f"{src}/horse_data_3_to_4_2.ndjson", "w") as f:
        f.write('{"id":3}\n')
    with open(f"{src}/other.ndjson", "w") as f:
        f.write('{"id":99}\n')
    incremental_shards(shard_stream(spark, src), sink, ckpt)
    assert sorted(r.line for r in spark.read.parquet(sink).collect()) == ['{"id":1}', '{"id":2}', '{"id":3}']


def test_incremental_upsert_replaces(spark, tmp_dir):
    src, tgt, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/tgt", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    with open(f"{src}/horse_data_1_to_3_1.ndjson", "w") as f:
        f.write('{"id":1,"v":"a"}\n{"id":1,"v":"dup"}\n{"id":2,"v":"b"}\nbad\n')
    schema = "id long, v string"
    incremental_upsert(shard_stream(spark, src), tgt, ckpt, schema, "id", "2024-01-01 00:00:00")
    with open(f"{src}/horse_data_1_to_3_2.ndjson", "w") as f:
        f.write('{"id":2,"v":"B"}\n{"id":3,"v":"c"}\n')
    incremental_upsert(shard_stream(spark, src), tgt, ckpt, schema, "id", "2024-01-02 00:00:00")
    out = sorted((r.id, r.v) for r in read_target(spark, tgt).collect())
    assert out == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_batch_replay_is_skipped(spark, tmp_dir):
    from tackroom.streaming.incremental import upsert_batch
    rows = [("s", "f", 0, '{"id":1,"v":"a"}', "f"), ("s", "f", 0, '{"id":2,"v":"b"}', "f")]
    cols = "shard string, file_path string, block_start long, line string, file_name string"
    b0 = spark.createDataFrame(rows, cols)
    b1 = spark.createDataFrame([("s", "g", 0, '{"id":2,"v":"B"}', "g")], cols)
    tgt = f"{tmp_dir}/t"
    assert upsert_batch(b0, 0, tgt, "id long, v string", "id", "2024-01-01 00:00:00", buckets=2)
    assert upsert_batch(b1, 1, tgt, "id long, v string", "id", "2024-01-02 00:00:00", buckets=2)
    # a replay of batch 0 (e.g. after a restart) must not undo batch 1
    assert not upsert_batch(b0, 0, tgt, "id long, v string", "id", "2024-01-03 00:00:00", buckets=2)
    out = sorted((r.id, r.v) for r in read_target(spark, tgt, key="id", buckets=2).collect())
    assert out == [(1, "a"), (2, "B")]


def test_ranged_upsert_rewrites_only_touched_ranges(spark, tmp_dir):
    import os as _os
    from tackroom.sources.tables import read_ranged, upsert_ranged
    root = f"{tmp_dir}/ranged"
    base = spark.createDataFrame([(i, f"v{i}") for i in range(0, 30)] + [(None, "n")], "id long, v string")
    upsert_ranged(base, root, "id", "2024-01-01 00:00:00", 10, f"{tmp_dir}/s1")
    stamp = {d: _os.path.getmtime(f"{root}/{d}") for d in _os.listdir(root) if d.startswith("_range=")}
    delta = spark.createDataFrame([(12, "X"), (15, "Y"), (35, "Z")], "id long, v string")
    upsert_ranged(delta, root, "id", "2024-01-02 00:00:00", 10, f"{tmp_dir}/s2")
    out = {r.id: r.v for r in read_ranged(spark, root).collect()}
    assert out[12] == "X" and out[15] == "Y" and out[35] == "Z" and out[11] == "v11" and out[None] == "n"
    assert len(out) == 32
    after = {d: _os.path.getmtime(f"{root}/{d}") for d in _os.listdir(root) if d.startswith("_range=")}
    assert after["_range=0"] == stamp["_range=0"] and after["_range=2"] == stamp["_range=2"]  # untouched
    assert "_range=3" in after  # new range inserted


def test_ranged_streaming_replay(spark, tmp_dir):
    from tackroom.streaming.incremental import upsert_batch_ranged
    from tackroom.sources.tables import read_ranged
    cols = "shard string, file_path string, block_start long, line string, file_name string"
    b0 = spark.createDataFrame([("s", "f", 0, '{"id":1,"v":"a"}', "f"), ("s", "f", 0, '{"id":21,"v":"b"}', "f")], cols)
    b1 = spark.createDataFrame([("s", "g", 0, '{"id":21,"v":"B"}', "g")], cols)
    tgt = f"{tmp_dir}/t"
    assert upsert_batch_ranged(b0, 0, tgt, "id long, v string", "id", "2024-01-01 00:00:00", 10)
    assert upsert_batch_ranged(b1, 1, tgt, "id long, v string", "id", "2024-01-02 00:00:00", 10)
    assert not upsert_batch_ranged(b0, 0, tgt, "id long, v string", "id", "2024-01-03 00:00:00", 10)
    assert sorted((r.id, r.v) for r in read_ranged(spark, tgt).collect()) == [(1, "a"), (21, "B")]


@pytest.mark.parametrize(("bad", "start"), [(None, 0), (-1, 0), (99, 100), (-150, -200)])
def test_ids_that_no_shard_can_hold_fail_the_landing(spark, tmp_dir, bad, start):
    df = spark.createDataFrame([(i, "x") for i in (100, 150, bad)], "k long, line string")
    for n, write in enumerate((write_batch_shards, write_line_shards)):
        with pytest.raises(Exception, match="out of range"):
            write(df, f"{tmp_dir}/{n}", "k", start, 100, 42)
        assert read_shard_lines(spark, f"{tmp_dir}/{n}", layout="partitioned").count() == 0
        write(df.where("k >= 100"), f"{tmp_dir}/{n}", "k", start, 100, 42)
        assert read_shard_lines(spark, f"{tmp_dir}/{n}", layout="partitioned").count() == 2
