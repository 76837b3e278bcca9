import corpus_pipeline
import llm_fixtures as fx
import pytest

SMALL = "/root/testdata/sf0.001"


def test_stages_on_planted_rows(spark, tmp_dir):
    item = " ".join(f"b{i}" for i in range(40))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(tmp_dir + "/benchmark.parquet")
    base = [" ".join(f"{w}{g}x{i}" for i in range(60) for w in ("the",)) for g in "abcdefgh"]
    texts = [*base, base[0] + " tail", "123 !!", None, "", base[1], item, "licence line of many words here\n" + "own words q " * 3,
             "licence line of many words here\n" + "other words r " * 3]
    d = fx.docs(spark, texts)
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, tmp_dir)
        assert out.columns == d.columns, name
        assert stage(spark, d.limit(0), tmp_dir).count() == 0
        path = f"{tmp_dir}/{name}"
        out.write.parquet(path)
        d = spark.read.parquet(path)
        ids = {r.doc_id: r.text for r in d.collect()}
        if name == "language_id":
            assert set(ids) == set(range(len(texts))) - {9, 10, 11}
        if name == "line_dedup":
            assert ids[12] == "" and ids[15] == "other words r " * 3 and ids[14] == texts[14] and ids[0] == texts[0]
            assert all(r.n_chars == len(r.text) for r in d.collect())
        if name == "decontamination":
            assert 13 not in ids and set(range(1, 8)) <= set(ids)
    out = by_name["bpe"](spark, d, tmp_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == d.count()
    assert all(r.n_tokens == len(r.ids) for r in out.collect())


def test_run_on_given_documents(spark):
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    total = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert 0.7 * total < len(rows) <= total and len({r.doc_id for r in rows}) == len(rows)


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_has_a_query(n):
    import __spark_entry__ as entry
    names = [x for x in entry.queries() if x.startswith(f"op{n}_")]
    assert len(names) == 1 and "pipeline" in entry.queries()
