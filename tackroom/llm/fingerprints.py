"""MinHash document fingerprints (operator 5).

Universal hash functions over the shingles of a text, in vectorised numpy
inside tasks. Documents and their successors meet without a global sort: a
bounded list of split points deals the rows to ranges of ids, each of which also
receives the first document of the next, and one pass over a sorted range sees
every pair of neighbours. Likeness is the share of equal minima.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.llm.hashing import MinHasher, shingle_hashes, word_hashes
from tackroom.llm.near_dedup import near_groups
from tackroom.llm.storage import materialize

PERMUTATIONS = 64
SHINGLE = 5            # words
SPLITS = 16384         # split points on the driver, at most; a range is streamed, so its size is no limit
_BATCH_CHARS = 1 << 20
_NO_ID = -(1 << 63)    # stands for a null id: sorts last


def _pack(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unpack(data: bytes, size: int) -> str:
    return pa.decompress(data, size, codec="zstd", asbytes=True).decode() if size else ""


def minima(texts: list[str], hasher: MinHasher, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The upper 16 bits of every minimum, per text, and whether the text has words at all."""
    words, first = word_hashes(pa.array(texts, pa.large_string()))
    sh, at = shingle_hashes(words, first, shingle)
    return (hasher.minima(sh, at) >> np.uint64(48)).astype(np.uint16), np.diff(at) > 0


def fingerprint_text(m: np.ndarray, has_words: bool) -> str:
    """Four hex digits a minimum; the empty text for a text without words."""
    return m.astype(">u2").tobytes().hex() if has_words else ""


def likeness(a: np.ndarray, has_a: bool, b: np.ndarray, has_b: bool) -> float:
    """Share of equal minima; texts without words are like each other and nothing else."""
    if not (has_a and has_b):
        return 1.0 if has_a == has_b else 0.0
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many (or all) of the first of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NEIGHBOUR_SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                    "near_edited double, near_next double")


def with_next(docs: DataFrame, id_col: str, text_col: str, chars_per_task: int) -> DataFrame:
    """(part, ghost, id, order, size, z): rows dealt to ranges of descending ids, sorted within, texts compressed.

    Every range ends with ghosts: the first document of the next range, and after the last that of the first.
    """
    # null ids come last; one range for every chars_per_task characters
    ids = materialize(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
                                  F.length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n")), "document-ids")
    row = ids.agg(F.sum("n").alias("n"), F.max("id").alias("top"), F.count("*").alias("rows")).first()
    n = int(min(SPLITS, max(1, (row["n"] or 0) // chars_per_task, row["rows"] // 50_000)))
    splits: list[int] = []
    if n > 1:  # cut at ids that exist: range p is the ids from splits[p] down to above splits[p + 1]
        cuts = ids.select(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"]
        splits = sorted({int(c) for c in cuts if c != row["top"]}, reverse=True)
    firsts = [row["top"] if row["top"] is not None else 0, *splits]
    return _compressed(docs, id_col, text_col, firsts).repartitionById(len(firsts), F.col("part")).sortWithinPartitions(
        "part", "ghost", F.col("id").desc(), "order")


def _compressed(docs: DataFrame, id_col: str, text_col: str, firsts: list[int]) -> DataFrame:
    """Rows and ghosts with their range; ``firsts`` are the ranges' largest ids, descending."""
    ascending = np.array([-x - 1 for x in firsts], dtype=np.int64)  # -x - 1: no overflow at the smallest id
    starts = {x: i for i, x in enumerate(firsts)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, ghost, ids, order, size, z = [], [], [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (t.as_py() or "").encode()
                packed, digest = _pack(data), sha256(data).digest()[:8]
                p = max(0, int(np.searchsorted(ascending, -i - 1, side="right")) - 1)
                part.append(p)
                ghost.append(False)
                if i in starts:
                    part.append((starts[i] - 1) % len(firsts))
                    ghost.append(True)
                for _ in range(len(part) - len(ids)):
                    ids.append(i)
                    order.append(digest)
                    size.append(len(data))
                    z.append(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(ghost, pa.bool_()), pa.array(ids, pa.int64()),
                 pa.array(order, pa.binary()), pa.array(size, pa.int64()), pa.array(z, pa.binary())],
                names=["part", "ghost", "id", "order", "size", "z"])
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "part int, ghost boolean, id long, order binary, size long, z binary")


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                           chars_per_task: int = 8_000_000) -> DataFrame:
    """One row per row of ``docs``: NEIGHBOUR_SCHEMA with ``id_col`` for id.

    The next document is the one with the next smaller id; after the last comes
    the first. Null texts are empty. Rows that share an id follow each other in
    the order of their texts' hashes, and rows without an id come last, so that
    every row has one next row; a single row is its own next. Fingerprints of
    equal texts are equal; a text without words has the empty fingerprint, which
    is like another empty one only. Empty tables give no rows; other columns are
    ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(PERMUTATIONS)
        held: tuple | None = None      # the row before: its id, text, minima
        part, over = None, False

        def give(pairs: list[tuple]) -> pa.RecordBatch:
            """Rows of (this, following), each (id, text, minima, has words)."""
            changed = [edited(a[1], b[1]) for a, b in pairs]
            m, has = minima(changed, hasher, shingle)
            return pa.RecordBatch.from_pydict({
                "id": pa.array([None if a[0] == _NO_ID else a[0] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                "edited_sha256": [sha256(x.encode()).hexdigest() for x in changed],
                "fingerprint": [fingerprint_text(a[2], a[3]) for a, _ in pairs],
                "edited_fingerprint": [fingerprint_text(x, h) for x, h in zip(m, has, strict=True)],
                "near_edited": pa.array([likeness(a[2], a[3], x, h) for (a, _), x, h in zip(pairs, m, has, strict=True)], pa.float64()),
                "near_next": pa.array([likeness(a[2], a[3], b[2], b[3]) for a, b in pairs], pa.float64())})

        for batch in batches:
            parts, ghosts, ids = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(ids):  # a bounded number of characters at a time
                stop, texts, chars = at, [], 0
                while stop < len(ids) and chars < _BATCH_CHARS:
                    size = batch.column(3)[stop].as_py()
                    texts.append(_unpack(batch.column(4)[stop].as_py(), size))
                    chars += len(texts[-1])
                    stop += 1
                m, has = minima(texts, hasher, shingle)
                pairs = []
                for j in range(at, stop):
                    row = (ids[j], texts[j - at], m[j - at], bool(has[j - at]))
                    if parts[j] != part:
                        part, over, held = parts[j], False, None
                    if over:
                        continue
                    if held is not None:
                        pairs.append((held, row))
                    held, over = row, ghosts[j]
                if pairs:
                    yield give(pairs)
                at = stop

    dealt = with_next(docs, id_col, text_col, chars_per_task).select("part", "ghost", "id", "size", "z")
    return dealt.mapInArrow(run, NEIGHBOUR_SCHEMA).withColumnRenamed("id", id_col)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose five-word shingle sets have a Jaccard similarity of 0.8 or more: signature bands are
    joined in Spark and every link is verified (see ``near_groups``)."""
    return near_groups(docs, id_col, text_col, shingle=SHINGLE, similarity=(80, 100))
