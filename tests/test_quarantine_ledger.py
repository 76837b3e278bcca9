"""What a run holds back, and which run consumed a shard."""

import os

from tackroom.operators.clean import clean_report
from tackroom.operators.quarantine import hold_back, read_quarantine, split_lines
from tackroom.plans.flows import merge_clean_upsert, merge_job
from tackroom.sources.ledger import read_ledger
from tackroom.sources.shards import ORDER_COLS, read_shard_lines
from tackroom.sources.tables import read_target
from tackroom.streaming.incremental import incremental_shards, incremental_upsert, shard_stream

DEEP = "[" * 1200 + "]" * 1200   # more nesting than the parser takes


def land(folder, **shards):
    os.makedirs(folder, exist_ok=True)
    for name, text in shards.items():
        with open(f"{folder}/horse_data_{name}.ndjson", "w") as f:
            f.write(text)


def test_every_class_is_held_back_and_nothing_stops_the_run(spark, tmp_dir):
    src, held = f"{tmp_dir}/src", f"{tmp_dir}/held"
    land(src, **{"1_to_9_1": '{"id":1,"n":"5"}\n{"id":2,"n":[{}]}\nnope\n\n{"n":1}\n{"id":3,"n":2.5}\n{"id":1,"n":6}\n' + DEEP + "\n"})
    for _ in range(2):  # a run that is repeated replaces its own rows
        merge_clean_upsert(spark, src, f"{tmp_dir}/t", "id long, n long", "id", "2024-01-01 00:00:00", quarantine=held)
    got = sorted((r["class"], r.field, r.value, r.line[:16]) for r in read_quarantine(spark, held).fillna("").collect())
    assert got == [("beyond_limits", "", "", "[" * 16), ("malformed", "", "", "nope"), ("misfit", "n", "2.5", '{"id":3,"n":2.5}'),
                   ("misfit", "n", "[{}]", '{"id":2,"n":[{}]'), ("missing_id", "", "", '{"n":1}')]
    assert [(r.id, r.n) for r in read_target(spark, f"{tmp_dir}/t").collect()] == [(1, 5)]
    merge_clean_upsert(spark, src, f"{tmp_dir}/t", "id long, n long", "id", "2024-01-02 00:00:00", quarantine=held)
    assert read_quarantine(spark, held).groupBy("run").count().count() == 2


def test_split_lines_groups_as_the_clean_step_does(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    land(src, **{"1_to_9_1": '{"id":1}\n\t\n{"id":1.0}\n{"id":"1"}\n{"id":0}\nx\n'})
    grouped, defects = split_lines(read_shard_lines(spark, src), f"{tmp_dir}/split", ORDER_COLS)
    r = clean_report(grouped).first()
    assert (r.kept, r.dupes) == (2, 1)
    assert sorted((d.status, d.line) for d in defects.collect()) == [("malformed", "x"), ("missing_id", '{"id":0}')]
    empty, none = split_lines(read_shard_lines(spark, f"{tmp_dir}/nothing"), f"{tmp_dir}/split0", ORDER_COLS)
    assert empty.count() == 0 and none.count() == 0
    hold_back(none, none.selectExpr("shard", "file_path", "line", "line AS field", "line AS value"), f"{tmp_dir}/held0", "r")


def test_one_ledger_for_batch_and_stream(spark, tmp_dir):
    src, ledger, sink, ckpt = (f"{tmp_dir}/{n}" for n in ("src", "ledger", "sink", "ckpt"))
    schema, ts = "id long, v string", "2024-01-01 00:00:00"
    names = lambda: sorted((r.file_path.rsplit("/", 1)[1][11:-7], r.consumer) for r in read_ledger(spark, ledger).collect())
    land(src, **{"1_to_2_1": '{"id":1,"v":"a"}\n', "3_to_4_1": ""})
    merge_clean_upsert(spark, src, f"{tmp_dir}/t", schema, "id", ts, ledger=ledger)
    assert names() == [("1_to_2_1", "batch"), ("3_to_4_1", "batch")]           # the empty one too
    land(src, **{"5_to_6_1": '{"id":5,"v":"b"}\n', "7_to_8_1": ""})
    incremental_shards(shard_stream(spark, src), sink, ckpt, ledger, src)
    assert [r.line for r in spark.read.parquet(sink).collect()] == ['{"id":5,"v":"b"}']  # not what the batch run took
    assert names() == [("1_to_2_1", "batch"), ("3_to_4_1", "batch"), ("5_to_6_1", "stream"), ("7_to_8_1", "stream")]
    # nothing is left for a batch run, nor for a merge job or another stream
    r = merge_clean_upsert(spark, src, f"{tmp_dir}/t", schema, "id", ts, ledger=ledger).first()
    assert (r.rows_source, r.rows_after) == (0, 1)
    assert merge_job(spark, src, f"{tmp_dir}/out", "m", ledger=ledger).first().status == "nothing_to_merge"
    incremental_upsert(shard_stream(spark, src), f"{tmp_dir}/u", f"{tmp_dir}/ckpt2", schema, "id", ts, ledger=ledger, root=src)
    assert read_target(spark, f"{tmp_dir}/u").count() == 0
    land(src, **{"9_to_9_1": '{"id":9,"v":"c"}\n'})
    incremental_upsert(shard_stream(spark, src), f"{tmp_dir}/u", f"{tmp_dir}/ckpt2", schema, "id", ts, ledger=ledger, root=src)
    assert [(r.id, r.v) for r in read_target(spark, f"{tmp_dir}/u").collect()] == [(9, "c")] and names()[-1] == ("9_to_9_1", "stream")
