import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tackroom.llm.ann import distances, distinct_vectors, fit, nearest, search, vectors_of
from tackroom.llm.partitioner import balanced_pieces

SCHEMA = "vec_id long, embedding array<float>, id long, key string, query int, vec int, unit int, score string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 1, "k", 2, 3, 4, "s")
                                  for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def brute(vectors, ids, every, k=10):
    rows = [(i, np.float32(v).astype(float)) for i, v in zip(ids, vectors, strict=True)
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, q in rows:
        if i % every == 0:
            near = sorted((float(np.sqrt(((q - v) ** 2).sum())), j) for j, v in rows if j != i)
            out[i] = near[:k]
    return out


def result(df, every, **options):
    out = {}
    for r in search(df, F.col("vec_id") % every == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def clusters(seed, groups, n, d, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    return (centres[rng.integers(0, groups, n)] + rng.normal(size=(n, d)) * spread).tolist()


def exact(spark, vectors, ids=None, every=3, **options):
    ids = list(range(len(vectors))) if ids is None else ids
    got, want = result(frame(spark, vectors, ids), every, **options), brute(vectors, ids, every)
    want = {q: v for q, v in want.items() if v}
    assert set(got) == set(want)
    for q, near in want.items():
        assert [r[0] for r in got[q]] == list(range(1, len(near) + 1))
        assert [r[1] for r in got[q]] == [j for _, j in near]
        assert [r[2] for r in got[q]] == pytest.approx([s for s, _ in near], abs=1e-12)


def test_one_piece_is_exact(spark):
    exact(spark, clusters(1, 5, 150, 8))
    exact(spark, clusters(2, 3, 200, 4), unit_bytes=32 * 40)   # its units are searched one by one and merged


def test_rows_that_take_no_part_ties_and_few_rows(spark):
    bad = [None, [], [0.0] * 3, [-0.0, 0.0, 0.0], [None, 1, 1], [float("nan")] * 3, [1, float("inf"), 0]]
    exact(spark, clusters(3, 2, 40, 3) + bad)
    exact(spark, [[1, 0, 0], [0, 1, 0], [0, 0, 1], [-1, 0, 0], [0, -1, 0], [0, 0, -1]] * 5)   # equal distances, equal vectors
    exact(spark, [[1, 2], [1, 2], [3, 4]], every=1)
    exact(spark, [[1.0, 2.0]], every=1)                       # no other row: no rows
    exact(spark, clusters(4, 1, 9, 3) + [[1, 1, 1]], [None, *range(9)], every=2)
    for rows in ([], [None, [0.0]]):
        got = search(frame(spark, rows), F.col("vec_id") % 2 == 0)
        assert got.count() == 0 and got.columns == ["query_id", "rank", "vec_id", "score"]
    with pytest.raises(ValueError, match="different lengths"):
        search(frame(spark, [[1], [1, 2]]), F.lit(True))


def test_a_vector_that_most_rows_share(spark):
    v = clusters(5, 4, 300, 6)
    exact(spark, v + [v[7]] * 400, every=5)
    exact(spark, v + [v[7]] * 400, [*range(0, 3000, 10), *range(5, 4005, 10)], every=5)


def test_repeated_rows_and_ids(spark):
    got = result(frame(spark, [[1, 0], [1, 0], [2, 0], [5, 0], [6, 0]], [0, 0, 1, 1, 3]), 3)
    assert got == {0: [(1, 1, 1.0), (2, 1, 4.0), (3, 3, 5.0)], 3: [(1, 1, 1.0), (2, 1, 4.0), (3, 0, 5.0), (4, 0, 5.0)]}


def test_recall_of_many_pieces(spark):
    v = clusters(6, 40, 4000, 16)
    df = frame(spark, v)
    got, want = result(df, 10, piece_rows=100, sample_rows=2000), brute(v, range(len(v)), 10)
    assert set(got) == set(want)
    for q, near in got.items():
        assert len(near) == 10 and [r[0] for r in near] == list(range(1, 11)) and q not in [r[1] for r in near]
        for _, j, s in near:   # whatever is found has its exact distance, in order
            assert s == pytest.approx(math.dist(np.float32(v[q]).astype(float), np.float32(v[j]).astype(float)), abs=1e-12)
        assert [(r[2], r[1]) for r in near] == sorted((r[2], r[1]) for r in near)
    hits = sum(len({r[1] for r in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    distinct = distinct_vectors(vectors_of(df, F.lit(True), "vec_id", "embedding"), 10)
    index = fit(distinct, len(v), 16, piece_rows=100, sample_rows=2000)
    assert index.pieces == 40 and index.probes < 20 and index.recall >= 0.95


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    got = result(df, 100, piece_rows=200)
    want = brute([r.embedding for r in rows], [r.vec_id for r in rows], 100)
    assert sum(len({r[1] for r in got[q]} & {j for _, j in want[q]}) for q in want) / (10 * len(want)) >= 0.9


def test_pieces_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(7)
    group = rng.permutation(np.repeat(np.arange(8), 50))      # eight separate groups of fifty
    near = np.stack([rng.choice(np.flatnonzero(group == g), 10) for g in group])
    piece = balanced_pieces(near, 8)
    assert set(np.bincount(piece)) == {50}
    assert (piece[near] == piece[:, None]).mean() > 0.9
    for n, p in ((103, 7), (10, 3), (5, 5), (64, 1)):
        sizes = np.bincount(balanced_pieces(rng.integers(0, n, (n, 4)), p), minlength=p)
        assert sizes.max() - sizes.min() <= 1


def test_distances_stay_finite():
    big = np.array([[1e200, 0], [-1e200, 1e200], [0, 0]])
    assert distances(big[0], big).tolist() == pytest.approx([0, math.hypot(2e200, 1e200), 1e200])
    assert [r.tolist() for r, _ in nearest(big[:1], big, np.arange(3), 3)] == [[0, 2, 1]]
