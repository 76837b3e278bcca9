"""Approximate nearest neighbours by learned partitions (operator 12).

A sample bounded by SAMPLE rows gives the index: its neighbour graph, found in
tasks, is cut into balanced pieces; a small classifier learns which pieces hold
the neighbours of a vector. Every vector is filed under its likeliest piece. A
query goes to its several likeliest pieces, whose vectors are ranked by exact
distances. How many pieces that is, is set on rows held out of the sample, whose
neighbours are known, so that the wanted recall is met.

Equal vectors are one entry with the smallest of their ids (no other of them can
be among the nearest), and equal queries are one query, so a vector that many
rows share is compared once. A piece of any size is dealt over tasks in units of
UNIT_BYTES; queries are streamed past the unit that a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from tackroom.llm.partitioner import Router, balanced_pieces, train_router
from tackroom.llm.storage import materialize
from tackroom.llm.vectors import finite_rows

K = 10
SAMPLE = 20_000              # rows that the index is fitted on, about, at most
SAMPLE_BYTES = 64 << 20      # and their size
HELD_OUT = 1000              # of these, queries that set the number of pieces to search
PIECE_ROWS, PIECES = 2000, 256
RECALL = 0.95                # aimed at on the held-out queries
UNIT_BYTES = 32 << 20        # vectors that a task holds
_BLOCK = 1 << 21             # distances worked out at a time
_SALTS = 8


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of one vector to rows, from the differences."""
    d = x - q
    top = np.abs(d).max(initial=0.0)
    scale = 2.0 ** np.floor(np.log2(top)) if top > 1e150 else 1.0   # squares stay finite
    d = d / scale
    return np.sqrt((d * d).sum(axis=1)) * scale


def nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every row of q the (rows of x, distances) of its k nearest, nearest first, ties by ``ids``: products choose
    what can be among them, differences rank it."""
    k = min(k, len(x))
    scale = max(np.abs(x).max(initial=0.0), np.abs(q).max(initial=0.0), 1e-300)
    xs = x / scale
    xx = (xs * xs).sum(axis=1)
    step = max(1, _BLOCK // max(1, len(x)))
    for a in range(0, len(q), step):
        qs = q[a:a + step] / scale
        qq = (qs * qs).sum(axis=1)
        approx = xx - 2 * (qs @ xs.T)
        kth = np.partition(approx, k - 1, axis=1)[:, k - 1]
        near = approx <= (kth + 1e-12 * (qq + xx.max()) * x.shape[1])[:, None]   # far above the products' rounding
        for i in range(len(qs)):
            rows = np.flatnonzero(near[i])
            d = distances(q[a + i], x[rows])
            best = np.lexsort((ids[rows], d))[:k]
            yield rows[best], d[best]


def _stack(column: pa.Array) -> np.ndarray:
    """The matrix of a column of vectors of one length without nulls."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def vectors_of(df: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, query, key, vec) of the rows that take part; equal vectors have equal keys, a 128-bit digest."""
    kind = df.schema[vec_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in finite_rows(batch.column(2)):
                some = x.any(axis=1)
                rows, x = rows[some], x[some] + 0.0    # -0.0 is 0.0
                if len(rows):
                    keys = [blake2b(v.tobytes(), digest_size=16).digest() for v in x]
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.binary()), batch.column(2).take(at)],
                        names=["id", "query", "key", "vec"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
                     F.col(vec_col).alias("vec")).where(F.col("id").isNotNull())
    return rows.mapInArrow(run, StructType([StructField("id", LongType()), StructField("query", BooleanType()),
                                            StructField("key", BinaryType()), StructField("vec", kind)]))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(key, vec, ids): every different vector with its k + 1 smallest ids; those beyond cannot be among the k nearest
    of anything. The limit of the ranking works before the exchange, so a frequent vector is cut down in each task."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    return vectors.withColumn("_rank", rank).where(F.col("_rank") <= k + 1) \
        .groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))


def neighbour_graph(sample: np.ndarray, spark, k: int) -> np.ndarray:
    """The k nearest rows of every sample row, found in tasks against the sample (bounded, so broadcast)."""
    shared = spark.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        ids = np.arange(len(x))
        for batch in batches:
            at = batch.column(0).to_numpy()
            found = [r[r != i][:k] for i, (r, _) in zip(at, nearest(x[at], x, ids, k + 1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tolist() for f in found], pa.list_(pa.int64()))],
                                             names=["id", "near"])

    parts = max(1, min(len(sample) // 200, 64))
    rows = spark.range(0, len(sample), 1, parts).mapInArrow(run, "id long, near array<long>").collect()
    out = np.full((len(sample), k), -1)
    for r in rows:
        out[r["id"], :len(r["near"])] = r["near"]
    shared.unpersist()
    return out


@dataclass(frozen=True)
class Index:
    """What a search needs to know: pieces, the classifier (None for one piece), pieces to search and recall measured."""
    pieces: int
    router: Router | None
    probes: int
    recall: float

    def likeliest(self, x: np.ndarray, m: int) -> np.ndarray:
        return self.router.likeliest(x, m) if self.router is not None else np.zeros((len(x), 1), np.int64)


def fit(distinct: DataFrame, n: int, dims: int, k: int = K, sample_rows: int = SAMPLE, piece_rows: int = PIECE_ROWS,
        recall: float = RECALL) -> Index:
    """Learn the pieces from about ``sample_rows`` of the n different vectors (fewer, if they pass SAMPLE_BYTES), chosen
    by digest. One piece is enough for few vectors, and then a search is exact."""
    pieces = min(PIECES, n // piece_rows)
    if pieces < 2:
        return Index(1, None, 1, 1.0)
    want = min(sample_rows, SAMPLE_BYTES // (8 * dims))
    low = F.conv(F.substring(F.hex("key"), 1, 15), 16, 10).cast("long")     # 60 bits, evenly spread
    chosen = distinct.where(low < F.lit(int(min(1.0, want / n) * (1 << 60)))).orderBy("key").select("vec").toArrow()
    x = np.concatenate([_stack(c) for c in chosen.column(0).chunks]) if chosen.num_rows else np.zeros((0, dims))
    pieces = min(pieces, len(x) // (2 * k))
    if pieces < 2:
        return Index(1, None, 1, 1.0)
    held = min(HELD_OUT, len(x) // 10)
    queries, x = x[:held], x[held:]
    near = neighbour_graph(x, distinct.sparkSession, k)
    piece = balanced_pieces(near, pieces)
    share = np.zeros((len(x), pieces), np.float32)
    with_own = np.concatenate([near, np.arange(len(x))[:, None]], axis=1)
    known = with_own >= 0
    np.add.at(share, (np.nonzero(known)[0], piece[with_own[known]]), 1.0)
    router = train_router(x, share / share.sum(axis=1, keepdims=True))
    # how far down the list of pieces the neighbours of held-out rows lie
    filed = router.likeliest(x, 1)[:, 0]
    place = np.argsort(router.likeliest(queries, pieces), axis=1)
    depth = np.concatenate([place[i, filed[rows]] for i, (rows, _) in enumerate(nearest(queries, x, np.arange(len(x)), k))])
    reached = np.cumsum(np.bincount(depth, minlength=pieces)) / len(depth)
    probes = int(np.searchsorted(reached, recall)) + 1
    return Index(pieces, router, min(probes, pieces), float(reached[min(probes, pieces) - 1]))


def _routed(rows: DataFrame, index: Index, m: int) -> DataFrame:
    """The rows with ``pieces``: their m likeliest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = index.likeliest(_stack(batch.column(1)), m)
            at = pa.array(np.arange(len(best) + 1) * best.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(at, pa.array(best.ravel(), pa.int32()))],
                                             names=["key", "vec", "ids", "pieces"])
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *StructType.fromDDL("pieces array<int>").fields]))


def file_vectors(distinct: DataFrame, index: Index, unit_rows: int) -> tuple[DataFrame, list[int], list[int]]:
    """(every vector under its likeliest piece, the first unit of each piece and after the last, their numbers of units)."""
    filed = materialize(_routed(distinct, index, 1).withColumn("piece", F.get("pieces", 0)).drop("pieces"), "ann-filed")
    counts = {r["piece"]: r["n"] for r in filed.groupBy("piece").agg(F.count("*").alias("n")).collect()}  # a row a piece
    units = [-(-counts.get(p, 0) // unit_rows) for p in range(index.pieces)]
    first = [0]
    for u in units:
        first.append(first[-1] + u)
    return filed, first, units


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def _search_units(dealt: DataFrame, k: int) -> DataFrame:
    """(key, vec_ids, score) of the k + 1 nearest vectors in each unit; rows come by unit, vectors before queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, blocks, ready = None, [], None
        for batch in batches:
            units = batch.column(0).to_numpy()
            query = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            change = np.flatnonzero((units[1:] != units[:-1]) | (query[1:] != query[:-1])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(units)], strict=True):
                if units[lo] != unit:
                    unit, blocks, ready = units[lo], [], None
                x = _stack(batch.column(3).slice(lo, hi - lo))
                if not query[lo]:
                    blocks.append((x, batch.column(4).slice(lo, hi - lo)))
                    continue
                if ready is None:
                    if not blocks:
                        continue
                    ids = pa.concat_arrays([b[1] for b in blocks])
                    smallest = ids.flatten().to_numpy()[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
                    ready, blocks = (np.concatenate([b[0] for b in blocks]), ids, smallest), []
                stored, ids, smallest = ready
                keys, rows, scores = [], [], []
                for i, (r, d) in enumerate(nearest(x, stored, smallest, k + 1)):
                    keys.append(np.full(len(r), lo + i))
                    rows.append(r)
                    scores.append(d)
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(2).take(pa.array(np.concatenate(keys))), ids.take(pa.array(np.concatenate(rows))),
                         pa.array(np.concatenate(scores))], names=["key", "ids", "score"])
    return dealt.mapInArrow(run, "key binary, ids array<long>, score double")


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           sample_rows: int = SAMPLE, piece_rows: int = PIECE_ROWS, unit_bytes: int = UNIT_BYTES, recall: float = RECALL,
           index: Index | None = None) -> DataFrame:
    """(query_id, rank, ``id_col``, score): the k nearest rows found for every row for which ``is_query`` (a condition on
    columns of ``df``) holds, among all rows but itself; all of them, if they are fewer.

    Nearness is the smallest Euclidean distance of the original vectors in double
    precision, ties go to the smaller id. Vectors that are null, empty or all
    zero, or hold a null or an entry that is not finite, and rows without an id, take no part;
    empty tables give no rows; other columns are ignored. Rows that share an id
    each count as a neighbour, and are one query if their vectors are equal;
    no row is a neighbour of its own id, so a query whose id is repeated near it
    may get fewer. Vectors of different lengths are an error.
    """
    vectors = materialize(vectors_of(df, is_query, id_col, vec_col), "ann-vectors")
    found = vectors.agg(F.min(F.size("vec")).alias("lo"), F.max(F.size("vec")).alias("hi")).first()
    if found["lo"] is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_col),
                              F.lit(0.0).alias("score"))
    if found["lo"] != found["hi"]:
        raise ValueError(f"vectors of different lengths: {found['lo']} to {found['hi']}")
    dims = found["hi"]
    distinct = materialize(distinct_vectors(vectors, k), "ann-distinct")
    if index is None:
        index = fit(distinct, distinct.count(), dims, k, sample_rows, piece_rows, recall)
    wanted = vectors.where("query").select("id", "key").distinct()
    filed, first, units = file_vectors(distinct, index, max(1, unit_bytes // (8 * dims)))
    stored = filed.select(
        (_pick(first, F.col("piece")) + F.pmod(F.xxhash64("key"), _pick(units, F.col("piece"))).cast("int")).alias("unit"),
        F.lit(False).alias("query"), "key", "vec", "ids")
    asked = distinct.join(wanted.select("key").distinct(), "key", "left_semi").select("key", "vec", "ids")
    asked = _routed(asked, index, index.probes).select("key", "vec", F.explode("pieces").alias("piece"))
    asked = asked.where(_pick(units, F.col("piece")) > 0).select(
        F.explode(F.sequence(_pick(first, F.col("piece")), _pick(first, F.col("piece")) + _pick(units, F.col("piece")) - 1)).alias("unit"),
        F.lit(True).alias("query"), "key", "vec", F.array().cast("array<long>").alias("ids"))
    dealt = stored.unionByName(asked).repartitionById(first[-1], F.col("unit")).sortWithinPartitions("unit", "query")
    # of each unit k + 1 entries; ids are expanded, then the best k + 1 of all units
    hits = _search_units(dealt, k).select("key", F.explode("ids").alias("id"), "score")
    best = hits.withColumn("_rank", F.row_number().over(Window.partitionBy("key").orderBy("score", "id"))).where(F.col("_rank") <= k + 1) \
        .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("best"))
    best = materialize(best, "ann-best")
    # a vector that many query rows share is dealt over several tasks
    salted = best.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])))
    asked = wanted.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k)
    answers = asked.join(salted, ["key", "_salt"]).select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias(id_col), F.col("b.score").alias("score"))

