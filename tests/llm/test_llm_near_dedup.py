import random

import numpy as np
import pyarrow as pa

import llm_fixtures as fx
from tackroom.llm import hashing
from tackroom.llm.components import components
from tackroom.llm.near_dedup import estimate_floor, keep_first, near_groups


def rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_word_hashes_follow_words_across_blocks(monkeypatch):
    texts = ["a  B\tc", None, "", " x ", "é É a b c " * 50, "a b"]
    whole, first = hashing.word_hashes(pa.array(texts))
    monkeypatch.setattr(hashing, "_BLOCK", 7)
    parts, again = hashing.word_hashes(pa.array(texts))
    assert (whole == parts).all() and (first == again).all()
    assert np.diff(first).tolist() == [3, 0, 0, 1, 250, 2]
    assert whole[0] == whole[first[5]] and whole[1] == whole[first[5] + 1]
    assert len(set(whole[first[4]:first[5]].tolist())) == 5  # é and É differ: only A-Z is lower-cased


def test_minima_equal_direct_minima():
    words, first = hashing.word_hashes(pa.array(["a b c d e f g", "", "x", "a b c d e f g h i j"]))
    sh, at = hashing.shingle_hashes(words, first, 3)
    assert np.diff(at).tolist() == [5, 0, 1, 8]
    h = hashing.MinHasher(8)
    for block in (2, 3, 1000):
        m = h.minima(sh, at, block=block)
        for t in (0, 2, 3):
            direct = [min((int(x) * int(a) + int(b)) % 2**64 for x in sh[at[t]:at[t + 1]]) for a, b in zip(h.a, h.b, strict=True)]
            assert [int(x) for x in m[t]] == direct


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([a[:250], rng.integers(0, 2**63, 40).astype(np.uint64)])
    x = hashing.parity_bits(a, 1024) ^ hashing.parity_bits(b, 1024)
    assert sum(int(v).bit_count() for v in x.view(np.uint64)) <= 90
    assert 0.5 < estimate_floor(0.85) < 0.85


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(45)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == fx.components(edges, nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_against_brute_force(spark):
    texts = fx.near_copies(1, 4, 14, 60, 0.03) + fx.near_copies(2, 3, 8, 25, 0.01)
    texts += ["", None, "  \n", "one", "ONE", "two words", "two  words", texts[0], texts[0], "z y x", "Ünï x y z", "ünï x y z"]
    got = rows(near_groups(fx.docs(spark, texts), shingle=3, similarity=(85, 100)))
    assert got == fx.near_groups(dict(enumerate(texts)), 3, 85, 100)


def test_null_and_repeated_ids_and_empty_table(spark):
    d = fx.docs(spark, ["a b c d", "a b c d", "q r s t", "a b c d", "a b c d e"], [5, 5, 9, None, 3])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_groups(d, shingle=3, similarity=(1, 2)).collect()
                 if r.doc_id is not None)
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    kept = keep_first(d, shingle=3, similarity=(1, 2))
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]
    assert near_groups(d.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = ("one two three four five six", "other words that are not like it")
    rows = [(3, a), (5, a), (5, b), (9, b), (11, "something else again here now"), (None, b)]
    d = fx.docs(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_groups(d).where("doc_id is not null").collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False), (11, 11, True)]
    assert sorted(str(r.doc_id) for r in keep_first(d).collect()) == ["11", "3", "None"]
