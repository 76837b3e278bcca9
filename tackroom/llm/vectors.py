"""Vectors of Arrow batches as numpy matrices, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20    # entries of a matrix that is worked on at a time


def finite_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) of the vectors that are neither null nor empty and whose entries are all
    finite numbers; one pair for each length and block of rows, in row order within a length."""
    length = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(length)])[:-1]
    for d in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == d)
        step = max(1, BLOCK // d)
        for a in range(0, len(rows), step):
            block = rows[a:a + step]
            x = values[start[block][:, None] + np.arange(d)]
            good = np.isfinite(x).all(axis=1)
            if good.any():
                yield block[good], x[good]
