"""Benchmark decontamination by winnowing (operator 1); DataFrame functions only.

A window is ``window`` consecutive words of a benchmark item. From every run of
``window - gram + 1`` consecutive gram-word hashes the smallest is kept (its
leftmost place on ties), in items and documents alike. A span of ``window``
shared words holds exactly one such run, and the same smallest hash is kept on
both sides: every shared span meets in the join of the fingerprints. Each hit is
then extended to the windows around it, which are compared word by word.

Shuffled are fingerprints (one in five words) and the texts of documents with a
hit only; Spark broadcasts the benchmark side if its stored size is below the
session's threshold, and otherwise joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize
from tackroom.llm.text import ascii_lower, let, positions

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # the same words before A-Z are lower-cased
WINDOW = 13
GRAM = 5
_HIGH = -(1 << 32)          # the hash half of a fingerprint; the low half is its position
_LOW = (1 << 32) - 1


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    """The number of ``words``, without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(ANY_CASE)).cast("long")


def _grams(hashes: Column, k: int) -> Column:
    """Per position a long: 32 bits of the k-gram's hash, then the position."""
    return F.transform(positions(F.size(hashes) - (k - 1)), lambda i: F.xxhash64(
        F.lit(k), *(F.get(hashes, i + j) for j in range(k))).bitwiseAND(F.lit(_HIGH)).bitwiseOR(i.cast("long")))


def fingerprints(w: Column, window: int, gram: int) -> Column:
    """Winnowed fingerprints of a word array, distinct; none if it has fewer words than a window."""
    run = window - gram + 1
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(_grams(h, gram), lambda v: F.array_distinct(
        F.transform(positions(F.size(v) - (run - 1)), lambda i: F.array_min(F.slice(v, i + 1, run))))))


def _all_grams(w: Column, k: int) -> Column:
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: _grams(h, k))


def _fingerprint_rows(df: DataFrame, lengths: list[int], window: int, gram: int, keep: list[str]) -> DataFrame:
    """(keep..., len, hash, pos) for full windows, and for each shorter length that items have."""
    per_len = [F.struct(F.lit(n).alias("len"),
                        (fingerprints(F.col("w"), window, gram) if n == window else _all_grams(F.col("w"), n)).alias("v"))
               for n in lengths]
    return (df.select(*keep, F.explode(F.array(*per_len)).alias("p"))
            .select(*keep, F.col("p.len").alias("len"), F.explode("p.v").alias("v"))
            .select(*keep, "len", F.shiftright("v", 32).alias("hash"), F.col("v").bitwiseAND(F.lit(_LOW)).alias("pos")))


def _windows(w: Column, length: Column) -> Column:
    return F.transform(positions(F.size(w) - length + 1), lambda i: F.array_join(F.slice(w, i + 1, length), " "))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM, share: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit if it lies inside an occurrence of a window of some
    item; an item of fewer than ``window`` words, but not none, is one window.
    ``contaminated``: n_hit > 0 and share * n_hit >= n_words.

    Null and empty texts have no words and are never contaminated; items without
    words match nothing. Items without an id still hit, but are not counted
    among n_items. Repeated rows (same id and text) get equal results; rows that
    share an id with other texts are judged each by its own text. Ties between
    equal hashes are settled by exact comparison. Empty tables are fine on
    either side. Other columns are ignored, whatever their names.
    """
    return _judged(docs, benchmark, id_col, text_col, item_col, item_text_col, window, gram, share).drop("__k")


def _judged(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM, share: int = 20) -> DataFrame:
    """The rows of :func:`contamination` with the hash ``__k`` of id and text."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    doc = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    doc = doc.select("id", F.xxhash64("id", "text").alias("k"), "text")
    items = benchmark.select(F.col(item_col).alias("item"), words(F.col(item_text_col)).alias("w"))
    items = materialize(items.where(F.size("w") > 0)
                        .select("item", "w", F.least(F.size("w"), F.lit(window)).alias("len")), "benchmark-words")
    short = [r["len"] for r in items.where(F.col("len") < window).select("len").distinct().collect()]  # < window rows
    lengths = sorted(short) + [window]
    by_len = [_fingerprint_rows(items.where(F.col("len") == n), [n], window, gram, []) for n in lengths]
    keys = by_len[0]
    for other in by_len[1:]:
        keys = keys.union(other)
    keys = materialize(keys.select("len", "hash").distinct(), "benchmark-fingerprints")
    spans = materialize(items.select("item", "len", F.explode(_windows(F.col("w"), F.col("len"))).alias("span"))
                        .distinct(), "benchmark-windows")

    found = (_fingerprint_rows(doc.select("id", "k", words(F.col("text")).alias("w")), lengths, window, gram,
                               ["id", "k"])
             .join(keys, ["len", "hash"], "left_semi"))
    around = F.when(F.col("len") == window, F.greatest(F.col("pos") - (window - gram), F.lit(0))).otherwise(F.col("pos"))
    # the places of one document, so no more than it has words
    found = materialize(found.select("id", "k", "len", around.cast("int").alias("lo"), F.col("pos").cast("int").alias("hi"))
                        .groupBy(F.col("id").alias("hit_id"), F.col("k").alias("hit_k"))
                        .agg(F.collect_set(F.struct("len", "lo", "hi")).alias("at")), "fingerprint-hits")
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("k") == F.col("hit_k"))
    starts = F.array_distinct(F.flatten(F.transform("at", lambda a: F.transform(
        F.sequence(a["lo"], a["hi"]), lambda i: F.struct(a["len"].alias("len"), i.alias("start"))))))
    spots = (doc.join(found, same).select("id", "k", words(F.col("text")).alias("w"), starts.alias("s"))
             .select("id", "k", F.explode(F.transform(
                 F.filter("s", lambda s: s["start"] + s["len"] <= F.size("w")),
                 lambda s: F.struct(s["len"].alias("len"), s["start"].alias("start"),
                                    F.array_join(F.slice("w", s["start"] + 1, s["len"]), " ").alias("span")))).alias("x"))
             .select("id", "k", "x.len", "x.start", "x.span"))
    hits = materialize(spots.join(spans.select("len", "span").distinct(), ["len", "span"], "left_semi").distinct(), "hits")

    # words covered by the union of a document's hit windows
    by_doc = Window.partitionBy("id", "k").orderBy("start", "len")
    end = F.col("start") + F.col("len")
    before = F.coalesce(F.max(end).over(by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (hits.select("id", "k", F.greatest(end - F.greatest("start", before), F.lit(0)).alias("new"))
               .groupBy("id", "k").agg(F.sum("new").alias("n_hit")))
    named = (hits.select("id", "k", "len", "span").distinct().join(spans, ["len", "span"]).where("item is not null")
             .select("id", "k", F.col("item").cast("string").alias("item")).distinct()
             .groupBy("id", "k").agg(F.array_sort(F.collect_list("item")).alias("items")))
    both = materialize(
        covered.select(F.col("id").alias("hit_id"), F.col("k").alias("hit_k"), "n_hit")
        .join(named, F.col("hit_id").eqNullSafe(F.col("id")) & (F.col("hit_k") == F.col("k")), "left")
        .select("hit_id", "hit_k", "n_hit", "items"), "hit-documents")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return (doc.select("id", "k", count_words(F.col("text")).alias("n_words"))
            .join(both, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("k") == F.col("hit_k")), "left")
            .select(F.col("id").alias(id_col), F.col("k").alias("__k"), "n_words", n_hit.alias("n_hit"),
                    F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
                    ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. Each is judged by its own text: rows without an id, and rows that
    share an id with a contaminated one, stay unless contaminated themselves."""
    gone = (_judged(docs, benchmark, id_col, text_col, **options).where("contaminated")
            .select(F.col(id_col).alias("__gone"), "__k").distinct())
    same = F.col(id_col).eqNullSafe(F.col("__gone")) & (F.xxhash64(F.col(id_col), F.col(text_col)) == F.col("__k"))
    return docs.join(gone, same, "left_anti")
