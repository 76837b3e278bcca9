"""Embedding whitening (operator 13).

Entries become whole numbers, whose counts and sums are exact. Two passes fit:
one counts the rows and sums each dimension, one sums the outer products of the
centred rows; each task gives one row a dimension, which Spark adds up. The
leading components of that matrix (one row a dimension, so the driver's work, by
Householder tridiagonalisation, Sturm counts and inverse iteration) are sent to
the tasks, which project the rows in blocks. A third pass measures how far the
covariance of the result is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.llm.eigen import EPS, leading_eigenpairs
from tackroom.llm.vectors import finite_rows

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
_LARGEST = 1 << 61
_DECIMAL = pa.decimal128(38, 0)


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """``floor(SCALE * entry) + OFFSET`` as 64-bit integers; an entry beyond their range is an error."""
    y = np.floor(SCALE * x)
    if np.abs(y).max(initial=0.0) >= _LARGEST:
        raise ValueError("an entry is too large for a 64-bit whole number")
    return y.astype(np.int64) + OFFSET


def _exact(x: np.ndarray, *factors: int) -> np.ndarray:
    """The same integers as Python numbers, if products with the factors could pass 64 bits."""
    size = int(np.abs(x).max(initial=0)) + 1
    for f in factors:
        size *= max(1, f)
    return x.astype(object) if size >= 1 << 62 else x


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: rows, the integer part and remainder of every mean, components as rows."""
    n: int
    base: np.ndarray        # floor(S / n)
    rest: np.ndarray        # S - n * base
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance above rounding; others cannot be scaled to one."""
        return self.values > 16 * EPS * len(self.base) * (self.values[0] if len(self.values) else 0.0)

    @property
    def explained(self) -> list[float | None]:
        return [float(v) / self.trace if self.trace > 0 else None for v in self.values]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the means, rounded once."""
        return (x - self.base).astype(float) - self.rest.astype(float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        ok = self.usable
        out = np.full((len(x), len(self.values)), np.nan)
        out[:, ok] = self.centred(x) @ (self.vectors[ok] / np.sqrt(self.values[ok])[:, None]).T
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S) squared, exact: n^2 * sum(u^2) - 2 * n * sum(u * r) + sum(r^2)
        with u = x - base and r = rest."""
        u, d = x - self.base, x.shape[1]
        top = int(np.abs(u).max(initial=0)) + 1
        a = (_exact(u, top, d) ** 2).sum(axis=1)
        b = (_exact(u, self.n, d) * self.rest).sum(axis=1)
        c = sum(int(r) ** 2 for r in self.rest)
        return [self.n * (self.n * int(p) - 2 * int(q)) + c for p, q in zip(a.tolist(), b.tolist(), strict=True)]


def _vectors(df: DataFrame, vec_col: str) -> DataFrame:
    return df.select(F.col(vec_col).alias("vec"))


def _sums(df: DataFrame, vec_col: str) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension) of the vectors that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for _, v in finite_rows(batch.column(0)):
                x, d = whole_numbers(v), v.shape[1]
                n, s = total.get(d, (0, [0] * d))
                part = _exact(x, len(x)).sum(axis=0).tolist()
                total[d] = (n + len(x), [p + q for p, q in zip(s, part, strict=True)])
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([Decimal(y) for y in s], _DECIMAL)], names=["d", "i", "n", "s"])

    rows = _vectors(df, vec_col).mapInArrow(run, "d int, i int, n long, s decimal(38,0)") \
        .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect()  # a row a dimension
    if len({r["d"] for r in rows}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r['d'] for r in rows})}")
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def _summed(df: DataFrame, vec_col: str, d: int, rows_of) -> np.ndarray:
    """Sum over all blocks of rows of y.T @ y with y = rows_of(whole numbers), a (d, d) matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = np.zeros((d, d)), False
        for batch in batches:
            for _, v in finite_rows(batch.column(0)):
                y = rows_of(whole_numbers(v))
                m += y.T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], names=["i", "m"])

    cells = _vectors(df, vec_col).mapInArrow(run, "i int, m array<double>").select("i", F.posexplode("m").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v"))
    m = np.zeros((d, d))
    for r in cells.collect():  # one cell for each pair of dimensions
        m[r["i"], r["j"]] = r["v"]
    return m


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors that take part; None if there are none. Vectors of different lengths are an error."""
    n, s = _sums(df, vec_col)
    if not n:
        return None
    base = np.array([x // n for x in s], dtype=np.int64)
    rest = np.array([x % n for x in s], dtype=np.int64)
    centre = Whitening(n, base, rest, np.zeros(0), np.zeros((0, len(s))), 0.0)
    v = _summed(df, vec_col, len(s), centre.centred) / n
    values, vectors = leading_eigenpairs(v, components)
    return Whitening(n, base, rest, values, vectors, float(np.trace(v)))


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity, over the usable components;
    None if there is none. The rows are centred by the fit."""
    ok = model.usable
    if not ok.any():
        return None
    cov = _summed(df, vec_col, int(ok.sum()), lambda x: model.whitened(x)[:, ok]) / model.n
    return float(np.abs(cov - np.eye(len(cov))).max())


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(``id_col``, deviation, whitened array) of every row whose vector takes part.

    Vectors that are null or empty or hold a null or an entry that is not finite
    take no part; empty tables give no rows. Repeated rows and ids come out alike, rows
    without an id keep a null one, other columns are ignored. A component
    without variance has null in its place. A deviation beyond 64 bits is null.
    An entry whose whole number passes 64 bits, and vectors of different lengths, are errors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, v in finite_rows(batch.column(1)):
                x = whole_numbers(v)
                w = model.whitened(x)
                flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w).ravel())
                at = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                dev = [y if y < 1 << 63 else None for y in model.deviations(x)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(dev, pa.int64()), pa.ListArray.from_arrays(at, flat)],
                    names=["id", "deviation", "whitened"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    if model is None:
        return rows.where(F.lit(False)).select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("deviation"),
                                               F.array().cast("array<double>").alias("whitened"))
    return rows.mapInArrow(run, "id long, deviation long, whitened array<double>").withColumnRenamed("id", id_col)
