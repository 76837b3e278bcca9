"""Fill-in-the-middle transformation by displacement scatter (operator 11).

Every text is cut into prefix, middle and suffix by code points, and the parts
are put in another order between control strings. Inside a task a batch of
texts is one array of bytes: a scan finds the bytes at the cuts, a difference
array with one entry a segment becomes the shift of every byte by a running
sum, and one scatter writes the batch's output. The way back finds the control
strings in the output alone, and gathers with the inverse shifts.

A batch is gone through in windows of a fixed number of bytes, so that beside a
text and its output only a window's work arrays are held, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
TRANSFORMED, SPM = 90, 20      # per cent of texts cut, and of those per cent with the suffix first

_WINDOW = 1 << 20              # bytes that have work arrays at a time
_GROUP = 4 << 20               # bytes of texts laid out together (a longer text is alone)
_CONTROL = (PREFIX, SUFFIX, MIDDLE)
_PLAIN, _PSM, _SPM = "plain", "psm", "spm"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    a = column.cast(pa.large_string()).fill_null("")
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def _groups(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most _GROUP bytes, or one row."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _GROUP, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _windows(size: int) -> Iterator[tuple[int, int]]:
    for a in range(0, size, _WINDOW):
        yield a, min(size, a + _WINDOW)


def _starts(b: np.ndarray, a: int, z: int) -> np.ndarray:
    """Whether each byte of a window starts a code point."""
    return (b[a:z] & 0xC0) != 0x80


def code_points_before(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of code points that start before each of the ascending byte positions ``at``."""
    out, seen = np.zeros(len(at), np.int64), 0
    for a, z in _windows(len(b)):
        run = np.cumsum(_starts(b, a, z))
        lo, hi = np.searchsorted(at, [a, z], side="right")
        out[lo:hi] = seen + run[at[lo:hi] - a - 1]    # positions in (a, z]
        seen += int(run[-1])
    return out


def byte_positions(b: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Byte where each of the ascending code points ``ranks`` starts; the end for the one after the last."""
    out, seen = np.full(len(ranks), len(b), np.int64), 0
    for a, z in _windows(len(b)):
        where = np.flatnonzero(_starts(b, a, z))
        lo, hi = np.searchsorted(ranks, [seen, seen + len(where)], side="left")
        out[lo:hi] = a + where[ranks[lo:hi] - seen]
        seen += len(where)
    return out


def occurrences(b: np.ndarray, token: bytes) -> np.ndarray:
    """Positions of ``token`` in the bytes."""
    found = []
    for a, z in _windows(len(b)):
        end = min(len(b), z + len(token) - 1)
        if end - a < len(token):
            continue
        hit = b[a:end - len(token) + 1] == token[0]
        for i in range(1, len(token)):
            hit = hit & (b[a + i:end - len(token) + 1 + i] == token[i])
        found.append(a + np.flatnonzero(hit))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _rows_with(b: np.ndarray, at: np.ndarray, tokens: list[bytes]) -> np.ndarray:
    """Whether each row holds one of the tokens, whole."""
    out = np.zeros(len(at) - 1, bool)
    for t in tokens:
        pos = occurrences(b, t)
        row = np.searchsorted(at, pos, side="right") - 1
        out[row[pos + len(t) <= at[row + 1]]] = True
    return out


def displacements(begin: np.ndarray, shift: np.ndarray, a: int, z: int, carry: int) -> np.ndarray:
    """Shift of every position of [a, z): the running sum of a difference array with one entry a segment start."""
    diff = np.zeros(z - a, np.int64)
    lo, hi = np.searchsorted(begin, [a, z], side="left")
    np.add.at(diff, begin[lo:hi] - a, np.diff(shift[lo:hi], prepend=carry))
    return carry + np.cumsum(diff)


def _carry(begin: np.ndarray, shift: np.ndarray, a: int) -> int:
    """The shift in force just before position ``a``."""
    i = int(np.searchsorted(begin, a, side="left"))
    return int(shift[i - 1]) if i else 0


def scatter(b: np.ndarray, begin: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    """Write every byte to its place: position plus the shift of its segment."""
    for a, z in _windows(len(b)):
        out[np.arange(a, z) + displacements(begin, shift, a, z, _carry(begin, shift, a))] = b[a:z]


def gather(out: np.ndarray, begin: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    """The inverse of ``scatter``: every byte read from where it was put."""
    back = np.empty(size, np.uint8)
    for a, z in _windows(size):
        back[a:z] = out[np.arange(a, z) + displacements(begin, shift, a, z, _carry(begin, shift, a))]
    return back


def _interleave(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def _put(out: np.ndarray, at: np.ndarray, token: bytes) -> None:
    for i, x in enumerate(token):
        out[at + i] = x


def cut_and_scatter(b: np.ndarray, at: np.ndarray, h: np.ndarray, has_id: np.ndarray, transformed: int, spm: int) -> dict:
    """One group of texts: form, code points, part sizes and the laid-out output."""
    tokens = [t.encode() for t in _CONTROL]
    first = code_points_before(b, at)
    n = np.diff(first)
    plain = (n == 0) | ~has_id | (h[:, 2] % 100 >= transformed) | _rows_with(b, at, tokens)
    suffix_first = ~plain & (h[:, 3] % 100 < spm)
    x, y = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    lo, hi = np.where(plain, n, np.minimum(x, y)), np.where(plain, n, np.maximum(x, y))  # plain: all prefix
    cuts = byte_positions(b, _interleave(first[:-1] + lo, first[:-1] + hi)).reshape(-1, 2)
    head, mid, tail = cuts[:, 0] - at[:-1], cuts[:, 1] - cuts[:, 0], at[1:] - cuts[:, 1]
    lp, ls, lm = (len(t) for t in tokens)
    extra = np.where(plain, 0, lp + ls + lm)
    to = np.concatenate([[0], np.cumsum(np.diff(at) + extra)])
    start = to[:-1]
    prefix_at = start + np.where(plain, 0, np.where(suffix_first, ls + tail + lp, lp))
    suffix_at = start + np.where(suffix_first, ls, lp + head + ls)
    middle_at = start + lp + ls + lm + head + tail
    middle_at, suffix_at = (np.where(plain, start + head, v) for v in (middle_at, suffix_at))
    out = np.empty(int(to[-1]), np.uint8)
    begin = _interleave(at[:-1], cuts[:, 0], cuts[:, 1])
    scatter(b, begin, _interleave(prefix_at, middle_at, suffix_at) - begin, out)
    cut = ~plain
    for token, where in zip(tokens, (prefix_at - lp, suffix_at - ls, middle_at - lm), strict=True):
        _put(out, where[cut], token)
    return {"n": n, "plain": plain, "spm": suffix_first, "prefix": lo, "middle": hi - lo, "at": to, "out": out}


def find_and_gather(b: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts of one group of outputs: (bytes, offsets, whether each output has its form)."""
    tokens = [t.encode() for t in _CONTROL]
    rows = len(at) - 1
    count, place = np.zeros((3, rows), np.int64), np.zeros((3, rows), np.int64)
    for k, t in enumerate(tokens):
        pos = occurrences(b, t)
        row = np.searchsorted(at, pos, side="right") - 1
        whole = pos + len(t) <= at[row + 1]
        np.add.at(count[k], row[whole], 1)
        place[k][row[whole]] = pos[whole]
    lp, ls, lm = (len(t) for t in tokens)
    p, s, m = place
    psm, spm, plain = form == _PSM, form == _SPM, form == _PLAIN
    in_order = np.where(psm, (p == at[:-1]) & (p < s) & (s < m), (s == at[:-1]) & (s < p) & (p < m))
    cut = (psm | spm) & (count == 1).all(axis=0) & in_order
    known = cut | plain
    # where prefix, middle and suffix lie in the output, and how long they are
    prefix_at = np.where(cut, p + lp, at[:-1])
    middle_at = np.where(cut, m + lm, at[1:])
    suffix_at = np.where(cut, s + ls, at[1:])
    head = np.where(cut, np.where(psm, s, m) - prefix_at, np.where(known, np.diff(at), 0))
    mid = at[1:] - middle_at
    tail = np.where(cut, np.where(psm, m, p) - suffix_at, 0)
    to = np.concatenate([[0], np.cumsum(head + mid + tail)])
    begin = _interleave(to[:-1], to[:-1] + head, to[:-1] + head + mid)
    return gather(b, begin, _interleave(prefix_at, middle_at, suffix_at) - begin, int(to[-1])), to, known


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
                   transformed: int = TRANSFORMED, spm: int = SPM) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n (code points), form, prefix_chars, middle_chars and output.

    Cuts and form come from the SHA-256 of ``seed``, a colon and the decimal id:
    four unsigned numbers of 8 hex digits; the smaller of the first two modulo
    n + 1 ends the prefix, the larger the middle. ``transformed`` per cent of
    the texts are cut (third number), ``spm`` per cent of those start with the
    suffix (fourth). psm is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, spm
    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A text that is empty (null: empty)
    or holds a control string, and one without an id, stays as it is: form
    plain, null sizes. Repeated rows come out alike; rows that share an id are cut
    by the same numbers; empty tables give none; other columns are ignored. A text
    of any length is laid out whole; its task holds it and its output.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _bytes_of(batch.column(1))
            has_id = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            h = np.stack([batch.column(2 + i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            for lo, hi in _groups(at):
                got = cut_and_scatter(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], h[lo:hi], has_id[lo:hi], transformed, spm)
                form = np.where(got["plain"], _PLAIN, np.where(got["spm"], _SPM, _PSM))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(got["n"], pa.int64()), pa.array(form.tolist(), pa.string()),
                     pa.array(got["prefix"], pa.int64(), mask=got["plain"]), pa.array(got["middle"], pa.int64(), mask=got["plain"]),
                     _strings(got["out"], got["at"])],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    numbers = [F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
               .select("id", "text", digest.alias("_h")).select("id", "text", *numbers)
    return (rows.mapInArrow(run, "id long, n long, form string, prefix_chars long, middle_chars long, output string")
            .withColumnRenamed("id", id_col))


def restore(outputs: DataFrame, output_col: str = "output", form_col: str = "form", text_col: str = "text") -> DataFrame:
    """``outputs`` with ``output_col`` replaced by ``text_col``: the text, from output and form alone.

    An output that does not have its form (another order or number of control
    strings, an unknown or null form) gives a null text; a null output is empty,
    so it is only right as plain. Other columns are kept as they are.
    """
    if text_col in outputs.columns and text_col != output_col:
        raise ValueError(f"column {text_col} is already there")
    keep = [c for c in outputs.columns if c != output_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _bytes_of(batch.column(batch.num_columns - 2))
            form = np.array([f or "" for f in batch.column(batch.num_columns - 1).to_pylist()], dtype=object)
            for lo, hi in _groups(at):
                text, to, known = find_and_gather(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], form[lo:hi])
                texts = _strings(text, to)
                if not known.all():
                    texts = pc.if_else(pa.array(known), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))), texts],
                                                 names=[*keep, text_col])

    rows = outputs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{output_col}`").alias("_output"), F.col(f"`{form_col}`").alias("_form"))
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:len(keep)], StructField(text_col, StringType())]))
