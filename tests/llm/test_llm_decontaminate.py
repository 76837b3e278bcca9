import hashlib
import random
import re

import llm_fixtures as fx
from tackroom.llm.decontaminate import clean_documents, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(fx.ascii_lower(t or ""))


def brute(texts, items, window=13):
    spans = []
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        spans += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)] if n else []
    out = []
    for d, text in texts:
        w = words(text)
        hit, named = set(), set()
        for item, s in spans:
            for p in range(len(w) - len(s) + 1):
                if tuple(w[p:p + len(s)]) == s:
                    hit.update(range(p, p + len(s)))
                    if item is not None:
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, texts, items):
    d = fx.docs(spark, [t for _, t in texts], [i for i, _ in texts])
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(d, b)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    item_texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(n)) for n in (13, 14, 40, 12, 5, 1, 30)] + ["", None, "...", "Éa ÉA b"]
    items = [(i, t) for i, t in enumerate(item_texts)] + [(2, "again " * 20), (None, "null id " * 9)]
    texts = []
    for i in range(30):
        parts = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            src = words(rng.choice(item_texts[:3]))
            a = rng.randrange(len(src))
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = src[a:a + rng.randrange(1, 30)]
        texts.append((i, ", ".join(parts).upper()))
    texts += [(30, None), (31, ""), (32, "!!!"), (33, "again " * 300), (33, "again " * 300), (33, "other"), (None, "null id " * 50),
              (34, "éa éa b"), (35, "Éa Éa B")]
    assert run(spark, texts, items) == brute(texts, items)


def test_empty_tables_and_filter(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [(1, passage), (2, "clean text"), (3, passage + " x" * 500), (None, passage), (4, None)]
    assert run(spark, texts, [])[0][5] is False
    assert run(spark, [], [(1, passage)]) == []
    d = fx.docs(spark, [t for _, t in texts], [i for i, _ in texts])
    kept = clean_documents(d, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4"]  # 20 of 520 words are no twentieth


def test_rows_that_share_an_id_are_removed_one_by_one(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [(None, passage), (None, "clean without an id"), (None, None), (7, passage), (7, "clean with the id"), (7, passage)]
    d = fx.docs(spark, [t for _, t in texts], [i for i, _ in texts])
    kept = clean_documents(d, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("7", "clean with the id"), ("None", "None"), ("None", "clean without an id")]
