"""Loads, targets, streams and merges must not lose or change a record unnoticed."""

import os

import pytest
from pyspark.sql import functions as F

from tackroom.functions.records import load_records, typed_records
from tackroom.plans.flows import merge_clean_upsert, merge_job
from tackroom.sources.shards import list_shards
from tackroom.sources.tables import bucket_spec, load_staging, read_target, write_target
from tackroom.streaming.incremental import upsert_batch, upsert_batch_ranged


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "line string")


def test_ids_of_every_spelling(spark):
    df = lines(spark, '{"id":5.0,"v":1}', '{"id":"7","v":"x"}', '{"id":9,"v":true}', '{"id":1e2,"v":2.5}', '{"id":null}', "{}")
    got = [(r.id, r.v) for r in load_records(df, "id long, v string").collect()]
    assert got == [(5, "1"), (7, "x"), (9, "true"), (100, "2.5"), (None, None), (None, None)]


@pytest.mark.parametrize("line", ['{"id":true}', '{"id":"x"}', '{"id":5.5}', '{"id":[1]}', '{"id":1e30}', "[1]", "oops"])
def test_what_does_not_fit_fails_or_is_rejected(spark, tmp_dir, line):
    df = lines(spark, '{"id":1,"n":{"a":1}}', line)
    schema = "id long, n struct<a:int>"
    with pytest.raises(Exception, match="does not fit"):
        load_records(df, schema).select("n").collect()
    assert load_records(df, schema, rejects=f"{tmp_dir}/r").count() == 1
    assert [r.line for r in spark.read.parquet(f"{tmp_dir}/r").collect()] == [line]
    assert typed_records(df, schema).where(F.size("_bad") > 0).count() == 1


def test_nested_misfits_are_rows(spark, tmp_dir):
    schema = "id long, n struct<a:int,deep:struct<x:boolean>>, list array<struct<k:int>>"
    good = '{"id":1,"n":{"a":"7","deep":{"x":"true"},"other":[1]},"list":[{"k":1.0},null,{}]}'
    bad = '{"id":2,"n":{"a":"b","deep":{"x":1}},"list":[{"k":2},{"k":2.5},3]}'
    odd = '{"id":3,"n":[1],"list":{"k":1}}'
    df = lines(spark, good, bad, odd)
    with pytest.raises(Exception, match="does not fit"):
        load_records(df, schema).collect()
    kept = load_records(df, schema, rejects=f"{tmp_dir}/r").collect()
    assert [(r.id, r.n.a, r.n.deep.x, [e and e.k for e in r.list]) for r in kept] == [(1, 7, True, [1, None, None])]
    got = {r.line: (r.fields, [(m.field, m.value) for m in r.misfits]) for r in spark.read.parquet(f"{tmp_dir}/r").collect()}
    assert got == {bad: (["n", "list"], [("n.a", '"b"'), ("n.deep.x", "1"), ("list[1].k", "2.5"), ("list[2]", "3")]),
                   odd: (["n", "list"], [("n", "[1]"), ("list", '{"k":1}')])}


def test_whole_numbers_are_never_rounded(spark):
    good = {"5.0": 5, "5.000000000000000000000000000": 5, "1e3": 1000, "1.5e1": 15, "-0.0": 0, '"-7."': -7, '"+7"': 7, '".0"': 0, '"1E2"': 100,
            "9223372036854775807": 2**63 - 1, '"9223372036854775807"': 2**63 - 1, "1e17": 10**17}
    bad = ["5.0000000001", "5.0000000000000000000001", '"5.0000000000000000000001"', "1.55e1", '".5"', "9223372036854775808", '"."', '"1e30"', "1e19", '""']
    rows = typed_records(lines(spark, *[f'{{"a":{t}}}' for t in [*good, *bad]]), "a long").collect()
    assert [r.a for r in rows] == [*good.values(), *[None] * len(bad)]
    assert [bool(r._bad) for r in rows] == [False] * len(good) + [True] * len(bad)


def test_number_text_as_the_original_writes_it(spark):
    want = {"1e3": "1000", "5.0": "5", "1.50": "1.5", "-0.0": "0", "1e21": "1e+21", "123456789012345680000.0": "123456789012345680000",
            "0.000001": "0.000001", "1.5e-7": "1.5e-7", "12345678.9": "12345678.9", "7": "7", "true": "true", '"1e3"': "1e3"}
    rows = load_records(lines(spark, *[f'{{"a":{t}}}' for t in want]), "a string").collect()
    assert [r.a for r in rows] == list(want.values())


def test_tab_only_lines_are_no_records(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/s")
    with open(f"{tmp_dir}/s/a.ndjson", "w") as f:
        f.write('{"a":1}\n\t\n \t \u00a0\n{"a":2}\n')
    assert sorted(r.a for r in load_staging(spark, f"{tmp_dir}/s", "a long").collect()) == [1, 2]


def test_ids_that_are_one_key_once_typed(spark, tmp_dir):
    """``7`` and ``"7"`` are two ids to the clean step and one key of the target: the first wins, or the batch fails."""
    from tackroom.operators.upsert import DuplicateSourceKey
    from tackroom.sources.merge_on_read import read_merged
    from tackroom.sources.tables import read_ranged
    from tackroom.streaming.incremental import upsert_batch_delta
    order = "shard string, file_path string, block_start long, line string, file_name string"
    batch = spark.createDataFrame([("s", "p", 0, t, "f") for t in (
        '{"id":7,"v":"a"}', '{"id":"7","v":"b"}', '{"id":7.0,"v":"c"}', '{"id":"8","v":"d"}')], order).coalesce(1)
    schema, ts = "id long, v string", "2024-01-01 00:00:00"
    for n, (put, read) in enumerate((
            (lambda t, **k: upsert_batch(batch, 0, t, schema, "id", ts, **k), lambda t: read_target(spark, t)),
            (lambda t, **k: upsert_batch_ranged(batch, 0, t, schema, "id", ts, 10, **k), lambda t: read_ranged(spark, t)),
            (lambda t, **k: upsert_batch_delta(batch, 0, t, schema, "id", ts, **k), lambda t: read_merged(spark, t, "id")))):
        target = f"{tmp_dir}/t{n}"
        with pytest.raises(DuplicateSourceKey):
            put(f"{target}-strict", on_dup="fail")
        assert put(target)
        assert sorted((r.id, r.v) for r in read(target).collect()) == [(7, "a"), (8, "d")]


def test_staging_fails_on_bad_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/s")
    with open(f"{tmp_dir}/s/a.ndjson", "w") as f:
        f.write('{"a":1}\n\nnot json\n')
    with pytest.raises(Exception):  # noqa: B017
        load_staging(spark, f"{tmp_dir}/s", "a long").collect()
    with pytest.raises(Exception):  # noqa: B017
        load_staging(spark, f"{tmp_dir}/s").collect()
    assert load_staging(spark, f"{tmp_dir}/s", "a long", rejects=f"{tmp_dir}/r").count() == 1


def test_bucket_count_is_stored(spark, tmp_dir):
    df = spark.range(1000).withColumn("v", F.lit("a"))
    write_target(df, f"{tmp_dir}/t", key="id", buckets=8)
    assert bucket_spec(spark, f"{tmp_dir}/t") == ("id", 8)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("tackroom_target_")]:
        spark.sql(f"DROP TABLE `{name}`")  # as in a session that did not write it
    assert read_target(spark, f"{tmp_dir}/t").count() == 1000
    with pytest.raises(ValueError):
        read_target(spark, f"{tmp_dir}/t", key="id", buckets=4)


def test_second_run_finds_typed_ids_and_another_width(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/horse_data_1_to_9_1.ndjson", "w") as f:
        f.write('{"id":5.0}\n{"id":"7"}\n{"id":9}\n')
    for buckets in (4, 3):
        r = merge_clean_upsert(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", "id long", "id", "2024-01-01 00:00:00", buckets=buckets).first()
        assert (r.rows_after, r.balanced) == (3, True)
    assert sorted(r.id for r in read_target(spark, f"{tmp_dir}/t").collect()) == [5, 7, 9]


COLS = "shard string, file_path string, block_start long, line string, file_name string"


def batch(spark, *ids):
    return spark.createDataFrame([("s", "f", 0, '{"id":%d}' % i, "f") for i in ids], COLS)


def test_batches_of_other_streams_and_loads_are_not_replays(spark, tmp_dir):
    ts = "2024-01-01 00:00:00"
    write_target(spark.createDataFrame([(1,)], "id long").withColumn("updated_at", F.lit(ts).cast("timestamp")), f"{tmp_dir}/v")
    assert upsert_batch(batch(spark, 2), 0, f"{tmp_dir}/v", "id long", "id", ts, stream="a")
    assert upsert_batch(batch(spark, 3), 0, f"{tmp_dir}/v", "id long", "id", ts, stream="b")
    assert not upsert_batch(batch(spark, 3), 0, f"{tmp_dir}/v", "id long", "id", ts, stream="b")
    assert sorted(r.id for r in read_target(spark, f"{tmp_dir}/v").collect()) == [1, 2, 3]
    for n, stream in enumerate("ab"):
        assert upsert_batch_ranged(batch(spark, 20 * n + 1), 0, f"{tmp_dir}/r", "id long", "id", ts, 10, stream=stream)
        assert not upsert_batch_ranged(batch(spark, 20 * n + 1), 0, f"{tmp_dir}/r", "id long", "id", ts, 10, stream=stream)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/r").collect()) == [1, 21]


def test_empty_shards_are_listed_counted_and_retired(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for name, text in (("horse_data_1_to_2_1.ndjson", '{"id":1}\n'), ("horse_data_3_to_4_1.ndjson", ""),
                       ("horse_data_x_to_4_1.ndjson", "no"), ("other.ndjson", "no")):
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    assert sorted((r.shard, r.length) for r in list_shards(spark, src).collect()) == [
        ("horse_data_1_to_2_1.ndjson", 9), ("horse_data_3_to_4_1.ndjson", 0)]
    r = merge_job(spark, src, f"{tmp_dir}/out", "m", ledger=f"{tmp_dir}/ledger", remove_merged=True).first()
    assert (r.merged_count, r.line_count, r.status) == (2, 1, "merged")
    assert sorted(x for x in os.listdir(src) if not x.startswith(".")) == ["horse_data_x_to_4_1.ndjson", "other.ndjson"]
    with open(f"{src}/horse_data_5_to_6_1.ndjson", "w"):
        pass
    r = merge_job(spark, src, f"{tmp_dir}/out", "m2", ledger=f"{tmp_dir}/ledger").first()
    assert (r.merged_count, r.line_count, r.status) == (1, 0, "merged")


def test_checkpoint_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from tackroom import session

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
