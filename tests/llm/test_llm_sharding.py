from collections import Counter

import pytest

import llm_fixtures as fx
from tackroom.llm.sharding import SHARDS, SLOTS, assign, lookup_table, shard_balance, write_shards


def test_table_is_full_and_even_and_stable():
    table = lookup_table(SHARDS)
    n = Counter(table)
    assert len(table) == SLOTS and set(n) == set(range(len(SHARDS))) and max(n.values()) - min(n.values()) <= 1
    fewer = lookup_table(SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != len(SHARDS) - 1)
    assert moved < SLOTS * 0.15  # besides the lost shard's slots, few change hands
    assert lookup_table(["only"], 2) == [0, 0]


@pytest.mark.parametrize(("shards", "slots"), [((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b", "c"), 2)])
def test_bad_parameters_are_refused(shards, slots):
    with pytest.raises(ValueError):
        lookup_table(shards, slots)


def test_assign(spark):
    d = fx.docs(spark, ["a", None, "", "b", "b"], [1, 2, None, 4, 4])
    out = assign(d)
    assert out.columns == [*d.columns, "slot", "shard"]
    by = Counter((r.doc_id, r.shard) for r in out.collect())
    assert sum(by.values()) == 5 and by[4, next(s for i, s in by if i == 4)] == 2 and all(s in SHARDS for _, s in by)
    assert assign(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        assign(d.withColumnRenamed("key", "Shard"))
    assert sum(r.rows for r in shard_balance(out).collect()) == 5


def test_written_shards_hold_all_rows(spark, tmp_dir):
    d = fx.docs(spark, [f"t{i % 3}" for i in range(50)], [i % 5 for i in range(50)])
    write_shards(d, tmp_dir + "/out", shards=("a", "b", "c"), slots=101, files_per_shard=4)
    back = spark.read.parquet(tmp_dir + "/out")
    assert back.count() == 50
    assert all(len({r.shard for r in back.collect() if r.doc_id == i}) == 1 for i in range(5))
