"""BPE encoding and decoding by per-prefix dynamic programming (operator 2).

Every prefix of a word has exactly one last token in its encoding. An automaton
over the vocabulary gives the tokens that end at each place; the one whose pair
with the last token of the shorter prefix is stable is stored, and following
these back-pointers from the end gives the ids. Two tokens are a stable pair if
no merge across their border comes before the merges that build them.

The vocabulary file is named by a path that every executor can read (a library
installed there), and is loaded once a Python worker, with bounded caches;
texts are streamed in Arrow batches, whole, one row at a time.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from hashlib import sha256

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed by the vocabulary file's pre-tokenizer and the byte alphabet that it uses.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WORD_END = "</w>"
_WHITE = regex.compile(r"\s+")
_NOT_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")   # white space to str.split, not to the tokenizer

_PIECES, _CHUNKS, _PAIRS = 60_000, 100_000, 300_000   # entries of a generation of the per-worker caches
_LONG = 64             # letters of a piece or chunk that is worth keeping
_NEVER = 1 << 30


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100 on."""
    letters, extra = {b: chr(b) for b in _PRINTABLE}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Cache:
    """A bounded map of two generations: what was not asked for while a whole generation was added is forgotten, so
    frequent words stay whatever passes by."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def missed(self, key):
        """The value of a key that is not in ``young``, if the older generation has it."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PrefixEncoder:
    """Encoder and decoder for a word-level BPE vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") != _WORD_END or spec.get("decoder") is not None:
            raise ValueError("a BPE file with word ends and without decoder is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for text, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = text
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.rank: dict[tuple[int, int], int] = {}
        self.birth, self.parts = [-1] * len(self.tokens), [None] * len(self.tokens)
        for r, pair in enumerate(model["merges"]):
            a, b = (self.vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = self.vocab[self.tokens[a] + self.tokens[b]]
            self.rank.setdefault((a, b), r)
            if self.parts[whole] is None:
                self.birth[whole], self.parts[whole] = r, (a, b)
        self.letters = _byte_letters()
        self.final: dict[str, int] = {}
        self.inner = ahocorasick.Automaton()
        for text, i in self.vocab.items():
            if text.endswith(_WORD_END):
                self.final[text[:-len(_WORD_END)]] = i
            else:
                self.inner.add_word(text, (i, len(text)))
        self.inner.make_automaton()
        self.longest = max(map(len, self.final), default=0)   # of the tokens that end a piece
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special))) + ")") if self.special else None
        self.spines: tuple[dict, dict] = ({}, {})
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces, self.chunks = Cache(_PIECES), Cache(_CHUNKS)

    def _spine(self, token: int, side: int) -> list[int]:
        """The tokens on one border of a token, from its first symbol up to itself."""
        spine = self.spines[side].get(token)
        if spine is None:
            spine = [token]
            while self.parts[spine[-1]] is not None:
                spine.append(self.parts[spine[-1]][1 - side])
            spine.reverse()
            self.spines[side][token] = spine
        return spine

    def stable(self, a: int, b: int) -> bool:
        """Whether text that ends in token a and goes on with token b keeps the border between them."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        left, right = self._spine(a, 0), self._spine(b, 1)
        i = j = 0
        while True:
            across = self.rank.get((left[i], right[j]), _NEVER)
            grow_a = self.birth[left[i + 1]] if i + 1 < len(left) else _NEVER
            grow_b = self.birth[right[j + 1]] if j + 1 < len(right) else _NEVER
            if across < grow_a and across <= grow_b:  # equal ranks merge from the left
                result = False
                break
            if grow_a == grow_b == _NEVER:
                result = True
                break
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = result
        return result

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one pre-tokenized piece."""
        # printable ASCII stands for itself
        s = piece if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
        n, final, known = len(s), self.final, self.pairs.get
        token = final.get(s)
        if token is not None:
            return (token,)
        # per prefix length: its last token, and where that starts
        last, begin = [0] * n, [-1] * n     # -1: not found yet
        for end, (token, length) in self.inner.iter(s, 0, n - 1):
            end += 1
            if begin[end] < 0:
                start = end - length
                if start:
                    pair = (last[start], token)
                    ok = known(pair)
                    if not (self.stable(*pair) if ok is None else ok):
                        continue
                last[end], begin[end] = token, start
        for start in range(max(1, n - self.longest), n):
            token = final.get(s[start:])
            if token is not None and self.stable(last[start], token):
                out = [token]
                while start:
                    out.append(last[start])
                    start = begin[start]
                return tuple(reversed(out))
        raise ValueError(f"no encoding of {piece!r}")

    def _chunk(self, chunk: str) -> tuple[str, str]:
        if chunk.isascii():
            text = chunk.lower()
            pieces = [text] if text.isalpha() else _PIECE.findall(text)
        else:
            text = unicodedata.normalize("NFC", chunk)
            pieces = _PIECE.findall("".join([c.lower() for c in text]))
        ids: list[int] = []
        for piece in pieces:
            got = self.pieces.young.get(piece) or self.pieces.missed(piece)
            if got is None:
                got = self.encode_piece(piece)
                if len(piece) <= _LONG:
                    self.pieces.put(piece, got)
            ids.extend(got)
        return " ".join([self.decimal[i] for i in ids]), " ".join([self.tokens[i] for i in ids])

    def _plain(self, text: str, ids: list[str], decoded: list[str]) -> None:
        chunks = self.chunks
        odd = any(c in text for c in _NOT_WHITE)
        for chunk in _WHITE.split(text) if odd else text.split():
            got = chunks.young.get(chunk) or chunks.missed(chunk)
            if got is None:
                got = self._chunk(chunk)
                if len(chunk) <= _LONG:
                    chunks.put(chunk, got)
            if got[0]:
                ids.append(got[0])
                decoded.append(got[1])

    def encode(self, text: str) -> tuple[str, str]:
        """Decimal ids, and the decoded tokens, each joined by one space."""
        ids: list[str] = []
        decoded: list[str] = []
        if self.split_special is not None and "<|" in text:
            for i, part in enumerate(self.split_special.split(text)):
                if i % 2:
                    ids.append(str(self.special[part]))
                    decoded.append(part)
                else:
                    self._plain(part, ids, decoded)
        else:
            self._plain(text, ids, decoded)
        return " ".join(ids), " ".join(decoded)

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


_LOADED: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """The encoder of a vocabulary file, loaded once a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PrefixEncoder(path)
    return _LOADED[path]


OUTPUTS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(),
           "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
_SQL = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
             outputs: Sequence[str] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and the asked-for ``outputs`` (see OUTPUTS).

    ``ids`` are those of the vocabulary file ``tokenizer`` without special tokens
    added; special tokens' strings in a text become their ids. ``decoded`` joins
    the tokens of the ids by one space, special ones too. Digests are SHA-256 of
    the decimal ids joined by one space and of the decoded text. Null and empty
    texts, and texts of white space, have no ids. Repeated rows are encoded
    alike; empty tables give none; other columns are ignored.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    want = list(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in want}
            for text in batch.column(1):
                ids, decoded = enc.encode(text.as_py() or "")
                for c, out in cols.items():
                    if c == "n_tokens":
                        out.append(ids.count(" ") + 1 if ids else 0)
                    elif c == "ids":
                        out.append([int(x) for x in ids.split()])
                    elif c == "decoded":
                        out.append(decoded)
                    elif c == "ids_sha256":
                        out.append(sha256(ids.encode()).hexdigest())
                    else:
                        out.append(sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(cols[c], OUTPUTS[c]) for c in want)],
                                             names=["id", *want])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, "id long, " + ", ".join(f"{c} {_SQL[c]}" for c in want))
            .withColumnRenamed("id", id_col))


def detokenize(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` from arrays of ids (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([enc.decode(x.as_py() or []) for x in batch.column(1)], pa.string())],
                names=["id", "decoded"])
    return (encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "id long, decoded string").withColumnRenamed("id", id_col))
