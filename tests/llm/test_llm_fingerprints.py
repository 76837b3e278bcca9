import hashlib

import llm_fixtures as fx
from tackroom.llm.fingerprints import near_copies, neighbour_fingerprints


def brute(texts):
    order = sorted(texts, reverse=True)
    out = {}
    for n, d in enumerate(order):
        t, nxt = texts[d] or "", texts[order[(n + 1) % len(order)]] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), len(set(t.split())), e == t, t, nxt)
    return out


def check(spark, texts, ids=None, **options):
    ids = list(range(len(texts))) if ids is None else ids
    got = {r.doc_id: r for r in neighbour_fingerprints(fx.docs(spark, texts, ids), **options).collect()}
    want = brute(dict(zip(ids, texts, strict=True)))
    assert set(got) == set(want)
    by_text = {}
    for d, (n, digest, n_words, same, t, nxt) in want.items():
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_next == 1 or t != nxt
        assert r.near_edited == 1 or not same
        assert (r.fingerprint == "") == (n_words == 0)
    return got


def test_neighbours_in_one_range_and_in_many(spark):
    texts = fx.near_copies(3, 10, 6, 60, 0.2) + [None, "", " ", "é" * 7, "x", "one two", fx.near_copies(3, 1, 1, 60, 0)[0]] * 2
    ids = [7 * i - 40 for i in range(len(texts))]
    one = check(spark, texts, ids)
    assert check(spark, texts, ids, chars_per_task=900) == one


def test_single_empty_and_tied_rows(spark):
    only = check(spark, ["a b c d e f g h"])
    assert only[0].near_next == 1
    assert neighbour_fingerprints(fx.docs(spark, [])).count() == 0
    d = fx.docs(spark, ["a b", "c d", "c d", "e", None], [1, 1, 1, None, 2])
    rows = neighbour_fingerprints(d).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "1", "2", "None"]
    assert sum(r.near_next == 1 for r in rows) == 1  # the repeated row follows its like


def test_edited_half_lowers_likeness(spark):
    texts = fx.near_copies(4, 12, 1, 200, 0)
    assert all(0.1 < r.near_edited < 0.7 and r.near_next < 0.1 for r in check(spark, texts).values())


def test_near_copies(spark):
    texts = fx.near_copies(5, 3, 5, 80, 0.01) + ["", None]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(fx.docs(spark, texts)).collect()}
    assert got == fx.near_groups(dict(enumerate(texts)), 5, 80, 100)
