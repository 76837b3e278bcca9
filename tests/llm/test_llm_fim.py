import hashlib
import random

import llm_fixtures as fx
import numpy as np
import pytest
from tackroom.llm import fim
from tackroom.llm.fim import fill_in_middle, restore


def brute(doc_id, text):
    t = text or ""
    n = len(t)
    if doc_id is None:
        return n, "plain", None, None, t
    h = [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    if not t or any(c in t for c in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    laid = fill_in_middle(fx.docs(spark, texts, ids))
    got = sorted((tuple(r) for r in laid.collect()), key=repr)
    want = sorted(((i, *brute(i, t)) for i, t in zip(ids, texts, strict=True)), key=repr)
    assert got == want
    back = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in restore(laid).collect())
    assert back == sorted((i if i is not None else -1, t or "") for i, t in zip(ids, texts, strict=True))
    return got


TEXTS = [None, "", "a", "ab", "é", "日本語のテキスト", "🙂🙃", "<P>", "a<S>b", "<M", "<", "<<P", "P>S>M>", "<P<S<M<", "x" * 500, "é🙂a" * 400,
         "\x00\n\t", "<P" * 9, ">" * 5]


def test_forms_cuts_and_round_trip(spark):
    rng = random.Random(11)
    texts = TEXTS + ["".join(rng.choice("ab<PSM>é日🙂 ") for _ in range(rng.randrange(60))) for _ in range(600)]
    got = check(spark, texts)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_small_windows_and_groups(spark, monkeypatch):
    """The same functions with windows of a few bytes: cuts, control strings and rows lie across their borders."""
    rng = random.Random(12)
    for window, group in ((1, 1), (2, 7), (3, 50), (5, 1000)):
        monkeypatch.setattr(fim, "_WINDOW", window)
        monkeypatch.setattr(fim, "_GROUP", group)
        texts = TEXTS + ["".join(rng.choice("ab<PSM>é日🙂") for _ in range(rng.randrange(30))) for _ in range(150)]
        data = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8)
        at = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])])
        h = np.array([[rng.randrange(1 << 32) for _ in range(4)] for _ in texts])
        for lo, hi in fim._groups(at):
            got = fim.cut_and_scatter(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], h[lo:hi], np.ones(hi - lo, bool), 90, 20)
            out = got["out"].tobytes()
            form = np.where(got["plain"], "plain", np.where(got["spm"], "spm", "psm")).astype(object)
            for i in range(hi - lo):
                t = texts[lo + i] or ""
                a, b = sorted((int(h[lo + i, 0] % (len(t) + 1)), int(h[lo + i, 1] % (len(t) + 1))))
                want = t
                if form[i] != "plain":
                    p, m, s = t[:a], t[a:b], t[b:]
                    want = f"<P>{p}<S>{s}<M>{m}" if form[i] == "psm" else f"<S>{s}<P>{p}<M>{m}"
                assert out[got["at"][i]:got["at"][i + 1]].decode() == want
            text, to, known = fim.find_and_gather(got["out"], got["at"], form)
            assert known.all() and (to == at[lo:hi + 1] - at[lo]).all() and (text == data[at[lo]:at[hi]]).all()


def test_long_text_ties_empty_table(spark):
    check(spark, ["é<P x" * 700_000, "tail"], [3, 4])          # 4 million code points, over several windows
    check(spark, ["same text", "same text", "other", None, "no id"], [5, 5, 5, 5, None])
    assert fill_in_middle(fx.docs(spark, [])).count() == 0
    assert restore(fill_in_middle(fx.docs(spark, []))).count() == 0


def test_outputs_without_their_form(spark):
    rows = [("psm", "<P>a<S>b<M>c", "acb"), ("spm", "<S>b<P>a<M>c", "acb"), ("plain", "<P>a", "<P>a"), ("plain", None, ""),
            ("psm", "<S>b<P>a<M>c", None), ("psm", "<P>a<S>b", None), ("psm", "x<P>a<S>b<M>c", None), (None, "x", None),
            ("psm", "<P>a<S>b<M>c<M>", None), ("other", "x", None), ("psm", None, None), ("psm", "<P><S><M>", "")]
    df = spark.createDataFrame([(f, o, i, 1.5) for i, (f, o, _) in enumerate(rows)], "form string, output string, at int, x double")
    got = {r["at"]: (r.text, r.x) for r in restore(df).collect()}
    assert got == {i: (t, 1.5) for i, (_, _, t) in enumerate(rows)}
    with pytest.raises(ValueError):
        restore(df, text_col="x")
