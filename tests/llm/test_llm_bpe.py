import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import llm_fixtures as fx
from tackroom.llm.bpe import detokenize, encoder, tokenize

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)

CASES = ["", "  ", "it's <|endoftext|>A<|startoftext|> ΑΣ İstanbul 12½ ² 一二 é é\x1c\x1db \x85x　y don't're'll 'sun ''s",
         "🎉🎉 ok🏳️‍🌈", "a" * 300 + "!" * 50, "ﬁ Å K ſ ǅ ẞ", "<|endoftext|><|endoftext|>", "<|end", "\x00\x01 ​﻿",
         "nfc é ̈́ 가", "  x", "x" * 20_000]


def random_texts(seed, n):
    rng = random.Random(seed)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "aeinrst", "ABCé üß'", "0123456789.,;:!?-_", "αβγδ жзий", "漢字かな", "'stremldv "]
    return [" ".join("".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(1, 18)))
                     for _ in range(rng.randrange(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("texts", [CASES, random_texts(1, 300)])
def test_same_ids_and_text_as_the_library(texts):
    enc = encoder(PATH)
    for text in texts:
        ids = LIB.encode(text, add_special_tokens=False).ids
        got, decoded = enc.encode(text)
        assert got == " ".join(map(str, ids)), text
        assert decoded == LIB.decode(ids, skip_special_tokens=False) == enc.decode(ids)


def test_a_very_long_piece():
    rng = random.Random(3)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "漢字かな", "!?-.,"):
        text = "".join(rng.choice(alphabet) for _ in range(1_000_000 // len(alphabet[0].encode())))
        assert encoder(PATH).encode(text)[0] == " ".join(map(str, LIB.encode(text, add_special_tokens=False).ids))


def test_caches_stay_bounded(monkeypatch):
    from tackroom.llm import bpe
    for name in ("_PIECES", "_CHUNKS", "_PAIRS"):
        monkeypatch.setattr(bpe, name, 3)
    enc = bpe.PrefixEncoder(PATH)
    for text in random_texts(2, 20):
        assert enc.encode(text)[0] == " ".join(map(str, LIB.encode(text, add_special_tokens=False).ids))
    assert len(enc.pieces) <= 6 and len(enc.chunks) <= 6 and len(enc.pairs) <= 3


def test_tables(spark):
    texts = [*CASES, None]
    d = fx.docs(spark, texts)
    rows = {r.doc_id: r for r in tokenize(d, PATH, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()}
    for i, text in enumerate(texts):
        ids = LIB.encode(text or "", add_special_tokens=False).ids
        assert (rows[i].n_tokens, rows[i].ids) == (len(ids), ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(rows[i].decoded.encode()).hexdigest()
    back = {r.doc_id: r.decoded for r in detokenize(tokenize(d, PATH), PATH).collect()}
    assert back == {i: r.decoded for i, r in rows.items()}
    assert tokenize(d.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        tokenize(d, PATH, outputs=("nothing",))
