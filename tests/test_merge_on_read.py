"""The target that is merged when read: deltas, compaction, skipped files, counts, replays."""

import os
import random

import pytest

from tackroom.operators.upsert import DuplicateSourceKey
from tackroom.sources import merge_on_read as mor

SCHEMA = "id long, v string, tags array<string>"


def rows(spark, pairs):
    return spark.createDataFrame([(k, v, [v]) for k, v in pairs], SCHEMA)


def state(spark, root, **kw):
    return sorted(((r.id, r.v, tuple(r.tags), str(r.updated_at)[:10]) for r in mor.read_merged(spark, root, "id", **kw).collect()), key=repr)


def data_files(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet"))


def test_random_deltas_and_compactions_equal_a_full_rewrite(spark, tmp_dir):
    rng, root, want, nulls = random.Random(3), f"{tmp_dir}/t", {}, []
    for n in range(7):
        day = f"2024-01-{n + 1:02d}"
        some = {rng.randrange(60): f"v{n}-{i}" for i in range(rng.choice([0, 5, 25]))}
        free = [(None, f"null{n}")] * rng.randrange(3)
        mor.upsert_delta(rows(spark, [*some.items(), *free]), root, "id", f"{day} 00:00:00", files=3)
        want |= {k: (k, v, (v,), day) for k, v in some.items()}
        nulls += [(None, v, (v,), day) for _, v in free]
        if n in (2, 5):
            mor.compact(spark, root, "id", files=4)
        assert state(spark, root) == sorted([*want.values(), *nulls], key=repr)
        assert state(spark, root, lo=20, hi=40) == sorted((r for k, r in want.items() if 20 <= k <= 40), key=repr)
        assert state(spark, root, hi=5) == sorted((r for k, r in want.items() if k <= 5), key=repr)
    mor.compact(spark, root, "id")
    assert state(spark, root) == sorted([*want.values(), *nulls], key=repr)
    log = mor.reconcile_log(spark, root).orderBy("commit").collect()
    assert all(r.balanced for r in log) and log[-1].rows_after == len(want) + len(nulls)
    before = set(data_files(root))
    assert mor.vacuum(spark, root) and set(data_files(root)) < before
    assert state(spark, root) == sorted([*want.values(), *nulls], key=repr)


def test_a_delta_writes_only_its_own_rows_and_compaction_only_what_it_overlaps(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    mor.upsert_delta(rows(spark, [(i, "a") for i in range(1000)]), root, "id", "2024-01-01 00:00:00", files=10)
    first = data_files(root)
    assert len(first) == 10
    mor.upsert_delta(rows(spark, [(5, "b"), (7, "b")]), root, "id", "2024-01-02 00:00:00", files=1)
    new = set(data_files(root)) - set(first)
    assert len(new) == 1 and spark.read.parquet(*new).count() == 2
    assert mor.files_read(spark, root, lo=900) == (1, 11) and mor.files_read(spark, root, lo=3, hi=6) == (2, 11)
    assert mor.files_read(spark, root) == (11, 11)
    # a read between keys opens no other file
    assert len(mor.read_merged(spark, root, "id", lo=900).inputFiles()) == 1
    assert mor.compact(spark, root, "id", files=1) == 2
    live = {r.file for r in mor.manifest(spark, root).where("kind <> 'commit'").collect()}
    kept = {os.path.relpath(f, root) for f in first}
    assert len(live & kept) == 9 and len(live) == 10
    r = mor.reconcile_log(spark, root).where("op = 'compact'").first()
    assert (r.rows_source, r.rows_before, r.rows_replaced, r.rows_inserted, r.rows_after, r.balanced) == (2, 1000, 2, 0, 1000, True)
    assert mor.compact(spark, root, "id") is None


def test_replays_duplicates_and_other_columns(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    assert mor.read_merged(spark, root, "id") is None and mor.latest_commit(spark, root) is None
    assert mor.upsert_delta(rows(spark, [(1, "a")]), root, "id", "2024-01-01 00:00:00", txn="s/0") == 0
    assert mor.upsert_delta(rows(spark, [(1, "b")]), root, "id", "2024-01-02 00:00:00", txn="s/1") == 1
    assert mor.upsert_delta(rows(spark, [(1, "c")]), root, "id", "2024-01-03 00:00:00", txn="s/0") is None
    assert mor.compact(spark, root, "id") == 2
    assert mor.upsert_delta(rows(spark, [(1, "c")]), root, "id", "2024-01-03 00:00:00", txn="s/1") is None  # known after compaction
    assert [r[1] for r in state(spark, root)] == ["b"]
    with pytest.raises(DuplicateSourceKey):
        mor.upsert_delta(rows(spark, [(2, "x"), (2, "y")]), root, "id", "2024-01-04 00:00:00")
    with pytest.raises(ValueError, match="the target has"):
        mor.upsert_delta(spark.range(3), root, "id", "2024-01-04 00:00:00")
    assert [r[1] for r in state(spark, root)] == ["b"]


def test_a_failed_run_leaves_the_table_as_it_was(spark, tmp_dir):
    from pyspark.sql import functions as F
    root = f"{tmp_dir}/t"
    mor.upsert_delta(rows(spark, [(1, "a")]), root, "id", "2024-01-01 00:00:00")
    bad = rows(spark, [(1, "b"), (2, "b")]).withColumn("v", F.when(F.col("id") == 2, F.raise_error("x").cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="x"):
        mor.upsert_delta(bad, root, "id", "2024-01-02 00:00:00")
    assert state(spark, root) == [(1, "a", ("a",), "2024-01-01")] and mor.latest_commit(spark, root) == 0
    assert mor.upsert_delta(rows(spark, [(2, "c")]), root, "id", "2024-01-02 00:00:00") == 1   # its number is free again
    assert len(state(spark, root)) == 2


def test_many_null_keys_are_spread(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    df = rows(spark, [(None, f"n{i}") for i in range(3000)] + [(i, "k") for i in range(20)])
    mor.upsert_delta(df, root, "id", "2024-01-01 00:00:00", files=6)
    files = mor.manifest(spark, root).where("kind <> 'commit'").collect()
    assert len(files) == 6 and max(f.rows for f in files) < 1200 and sum(f.nulls for f in files) == 3000
    mor.upsert_delta(rows(spark, [(None, "n0")]), root, "id", "2024-01-02 00:00:00")
    assert len(state(spark, root)) == 3021
