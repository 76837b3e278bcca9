import zlib

import numpy as np

import llm_fixtures as fx
from tackroom.llm import langid
from tackroom.llm.langid import features, held_out, identify, keep_identified

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = identify(d).join(d.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == d.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in test]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet").limit(300)
    from pyspark.sql import functions as F
    other = d.withColumn("lang", F.when(held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    key = lambda df: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(df).collect())
    assert key(d) == key(other)


def test_features_cover_the_whole_text_whatever_the_block(monkeypatch):
    text = "Über den Fluss, 12 mal. " * 40 + "zebra"
    whole = features(text)
    monkeypatch.setattr(langid, "_BLOCK", 17)
    assert np.allclose(whole, features(text))
    assert features("12 !? ,") is None and features("") is None and features("12 a") is not None


def test_edges(spark):
    texts = ["the cat and the dog", None, "", "123 !!", "le chat et le chien", "the cat and the dog", "ein Hund und die Katze"] * 3
    d = fx.docs(spark, texts).withColumn("lang", __import__("pyspark.sql.functions", fromlist=["x"]).expr(
        "case when text like 'le%' then 'fr' when text like 'ein%' then 'de' when text like 'the%' then 'en' else 'xx' end"))
    rows = {r.doc_id: r for r in identify(d).collect()}
    assert len(rows) == 21
    for i, t in enumerate(texts):
        assert (rows[i].lang_pred == "und") == (not t or not any(c.isalpha() for c in t))
        assert rows[i].score == 0 or rows[i].lang_pred != "und"
    assert rows[0].lang_pred == rows[5].lang_pred == "en" and rows[4].lang_pred == "fr" and rows[6].lang_pred == "de"
    kept = keep_identified(d)
    assert kept.columns == d.columns and kept.schema == d.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.lang_pred != "und"}
    # nothing to learn from, one language only, no rows
    none = d.withColumn("lang", __import__("pyspark.sql.functions", fromlist=["x"]).lit(None).cast("string"))
    assert {r.lang_pred for r in identify(none).collect()} == {"und"}
    one = fx.docs(spark, ["a b", "c d", None], [1, 2, None])
    assert {r.lang_pred for r in identify(one).collect()} == {"en", "und"}
    assert identify(d.limit(0)).count() == 0 and keep_identified(d.limit(0)).count() == 0
