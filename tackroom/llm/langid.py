"""Hierarchical language identification (operator 4).

Letter n-grams of a whole text are hashed into a fixed number of features. A
linear support vector machine per language family picks the family; within it,
one machine per pair of languages votes. The machines are fitted on a bounded
sample of labelled texts, whose features the executors compute; the driver
holds that sample's features and the weights, whose sizes are parameters.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize

FEATURES = 4096         # hashed letter 1- to 3-grams
PER_LANGUAGE = 400      # labelled texts of a language to fit on, at most
MAX_LANGUAGES = 200     # languages to learn, at most; more are refused
UNKNOWN = "und"
_BLOCK = 1 << 20        # letters hashed at once

# Language code -> family. A code that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "nb": "germanic", "nn": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance", "gl": "romance",
    "ru": "slavic", "uk": "slavic", "be": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
    "sr": "slavic", "hr": "slavic", "sl": "slavic", "mk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
    "lt": "baltic", "lv": "baltic",
    "tr": "turkic", "az": "turkic", "kk": "turkic", "uz": "turkic",
    "hi": "indic", "bn": "indic", "mr": "indic", "ur": "indic", "ne": "indic", "pa": "indic", "gu": "indic",
    "ar": "semitic", "he": "semitic",
    "zh": "sinitic", "ja": "japonic", "ko": "koreanic",
}


@cache
def _letters() -> np.ndarray:
    """Per code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def features(text: str) -> np.ndarray | None:
    """Unit vector of square-rooted n-gram counts of the whole text; None if it has no letter."""
    total = np.zeros(FEATURES, dtype=np.int64)
    letters = _letters()
    found = False
    for at in range(0, len(text), _BLOCK):
        # two characters of the block before, so that no n-gram is lost at the border
        lead = min(at, 2)
        block = text[at - lead:at + _BLOCK].lower()
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[codes]
        found = found or bool(is_letter.any())
        c = np.where(is_letter, codes, 0x20).astype(np.uint32)
        if lead == 0:
            c = np.concatenate([[np.uint32(0x20)], c])
            is_letter = np.concatenate([[False], is_letter])
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        shift = np.uint32(32 - FEATURES.bit_length() + 1)
        skip = lead  # n-grams that end in the lead were counted with the block before
        total += np.bincount((one >> shift)[skip:][is_letter[skip:]], minlength=FEATURES)
        ends = max(0, skip - 1)
        total += np.bincount((two >> shift)[ends:][(is_letter[1:] | is_letter[:-1])[ends:]], minlength=FEATURES)
        total += np.bincount((three >> shift)[max(0, skip - 2):][is_letter[1:-1][max(0, skip - 2):]], minlength=FEATURES)
    if not found:
        return None
    v = np.sqrt(total.astype(np.float32))
    return v / np.linalg.norm(v)


def fit_svm(x: np.ndarray, positive: np.ndarray, epochs: int = 20, strength: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a linear SVM by averaged stochastic subgradients in a fixed order.

    Both classes weigh the same, however many rows they have.
    """
    n, d = x.shape
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())) * n
    w, mean, b, mean_b = np.zeros(d), np.zeros(d), 0.0, 0.0
    order = np.random.Generator(np.random.PCG64(11))
    step, averaged = 0, 0
    for epoch in range(epochs):
        for i in order.permutation(n):
            step += 1
            rate = 1.0 / (strength * (step + 1.0 / strength))
            margin = y[i] * (x[i] @ w + b)
            w *= 1.0 - rate * strength
            if margin < 1:
                w += rate * share[i] * y[i] * x[i]
                b += 0.1 * rate * share[i] * y[i]
            if epoch >= epochs // 2:
                averaged += 1
                mean += (w - mean) / averaged
                mean_b += (b - mean_b) / averaged
    return np.append(mean, mean_b).astype(np.float32)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)           # of each family
    family_weights: np.ndarray | None = None                                 # one row per family, one against the rest
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)        # one row per pair of the family's languages

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        if not self.families:
            return UNKNOWN, 0.0
        family, score = self.families[0], 1.0
        if len(self.families) > 1:
            m = self.family_weights[:, :-1] @ v + self.family_weights[:, -1]
            best = np.argsort(-m, kind="stable")
            family = self.families[best[0]]
            score = _sure(m[best[0]] - m[best[1]])
        names = self.languages[family]
        if len(names) == 1:
            return names[0], score
        w = self.pair_weights[family]
        m = w[:, :-1] @ v + w[:, -1]
        votes, margins = defaultdict(int), defaultdict(float)
        weakest = {x: np.inf for x in names}
        for (a, b), margin in zip(combinations(names, 2), m, strict=True):
            votes[a if margin >= 0 else b] += 1
            margins[a] += margin
            margins[b] -= margin
            weakest[a] = min(weakest[a], margin)
            weakest[b] = min(weakest[b], -margin)
        lang = max(names, key=lambda x: (votes[x], margins[x]))
        return lang, score * _sure(2 * max(0.0, weakest[lang]))


def _sure(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-2.0 * float(np.clip(margin, -30, 30)))))


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """The family and pair machines of labelled feature rows."""
    names = sorted(set(langs))
    family = {x: FAMILIES.get(x.lower().split("-")[0], x) for x in names}
    label = np.array(langs)
    model = Model(sorted(set(family.values())))
    model.languages = {f: [x for x in names if family[x] == f] for f in model.families}
    if len(model.families) > 1:
        of = np.array([family[x] for x in langs])
        model.family_weights = np.stack([fit_svm(x, of == f) for f in model.families])
    for f, own in model.languages.items():
        rows = []
        for a, b in combinations(own, 2):
            two = (label == a) | (label == b)
            rows.append(fit_svm(x[two], label[two] == a))
        if rows:
            model.pair_weights[f] = np.stack(rows)
    return model


def _feature_rows(rows: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, vector as float32 bytes); texts without letters are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, vectors = [], []
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                v = features(text.as_py() or "")
                if v is not None:
                    langs.append(lang.as_py())
                    vectors.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(vectors, pa.binary())], names=["lang", "v"])
    return rows.select("lang", "text").mapInArrow(run, "lang string, v binary")


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column,
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the ``usable`` rows with a language: of each, the ``per_language`` with the smallest hashed ids.

    The choice does not depend on how rows are spread; each task keeps only its
    own ``per_language`` best of a language before the shuffle.
    """
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    rank = F.row_number().over(Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col))
    # written out: a small table, so that the join below needs no shuffle of the texts
    chosen = materialize(rows.select(id_col, lang_col).withColumn("__rank", rank).where(F.col("__rank") <= per_language)
                         .select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang")).distinct(), "language-sample")
    sample = (rows.join(chosen, (F.col(id_col) == F.col("__id")) & (F.col(lang_col) == F.col("__lang")), "left_semi")
              .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")))
    found = _feature_rows(sample).orderBy("lang", "v").limit(MAX_LANGUAGES * per_language + 1).collect()
    langs = [r["lang"] for r in found]
    if len(set(langs)) > MAX_LANGUAGES or len(found) > MAX_LANGUAGES * per_language:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return Model()
    return fit(np.stack([np.frombuffer(r["v"], dtype=np.float32) for r in found]).astype(np.float64), langs)


def held_out(id_col: str) -> Column:
    """True for one document in five, by its id's text; a row without an id is not held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, lang_pred, score.

    The model is learned from rows that are not held out and have a language.
    Null texts and texts without letters are ``und`` with score 0, as is every
    text if nothing could be learned. Rare languages, ties and repeated rows
    need no care: classes weigh the same, and equal texts get equal answers.
    """
    model = train(docs, id_col, text_col, lang_col, ~held_out(id_col), per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                v = features(text.as_py() or "")
                lang, score = (UNKNOWN, 0.0) if v is None else model.predict(v)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["id", "held_out", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))
    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` whose language is known, with it in ``lang_col``; all other columns stay as they are."""
    model = train(docs, id_col, text_col, lang_col, ~held_out(id_col), per_language)
    at = docs.columns.index(text_col)
    to = docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = []
            for text in batch.column(at):
                v = features(text.as_py() or "")
                langs.append(None if v is None else model.predict(v)[0])
            keep = pa.array([x is not None and x != UNKNOWN for x in langs], pa.bool_())
            columns = [pa.array(langs, pa.string()) if i == to else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(keep)
    return docs.mapInArrow(run, docs.schema)
