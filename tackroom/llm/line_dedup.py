"""Line dedup by an exact set-similarity join (operator 9); DataFrame functions only.

1. Word counts over all lines, in a table of fixed size (words share a counter
   by hash), give one rarity order for all tasks.
2. A line's distinct words become longs, rank first, then hash, sorted from rare
   to frequent. Lines with equal sets collapse to the first in document order.
3. Candidates share one of the rarest words of both (prefix filter) and pass the
   positional and length filters and a bound on the number of words that differ
   (parities of the words' hashes, which never err), all inside one join, where one
   exchange of the prefixes serves both sides. Before it, lines are compared with the
   earliest line of each word that many lines have in their prefix, and those that
   this settles ask for no partners, so a large group of variants does not become
   all its pairs. Of the candidates, a line's likeliest is verified first, the
   others only if that leaves the line unsettled.
4. Jaccard is verified on the words of both lines, and the later line goes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize
from tackroom.llm.text import let

SIMILARITY = (4, 5)      # Jaccard of two lines' word sets, as a fraction
COUNTERS = 1 << 16       # size of the rarity table, whatever the input
LONG = 64                # lines of so many words or more have 128 parity bits instead of 64
STAR = 128               # prefix words of more lines than this are paired as stars first
_OTHER_SPACE = "\t\x0b\f\r"
_HASH_BITS = 47
_LAST = (1 << 63) - 1
_RID_BITS = 56


def _spaced(line: Column) -> Column:
    """The line with all its ASCII white space as spaces."""
    odd = functools.reduce(lambda x, y: x | y, [F.contains(line, F.lit(c)) for c in _OTHER_SPACE])
    return F.when(odd, F.translate(line, _OTHER_SPACE, " " * len(_OTHER_SPACE))).otherwise(line)


def line_words(line: Column) -> Column:
    """Words of a line: runs of anything but ASCII white space, case kept."""
    return F.array_remove(F.split(_spaced(line), " "), "")


def _counter(h: Column) -> Column:
    return h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")


def _lines(doc: DataFrame) -> DataFrame:
    return doc.select("ord", "k", F.posexplode(F.split("text", "\n")).alias("line", "value"))


def _rarity(doc: DataFrame) -> Column:
    """Array counter -> 16 * log2(words counted), as one constant of COUNTERS small numbers."""
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    counts = (doc.select(F.explode(words).alias("w"))
              .groupBy(_counter(F.xxhash64("w")).alias("c")).count()
              .select("c", F.round(F.log2(F.col("count").cast("double")) * 16).cast("int").alias("r")).collect())
    table = [0] * COUNTERS  # the rows collected: COUNTERS at most, whatever the input
    for r in counts:
        table[r["c"]] = r["r"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def _filters(x: str, y: str, num: int, den: int) -> Column:
    """What a line x and an earlier line y must meet at their first common prefix word: the words before it are in one
    line only, those behind it bound the overlap, and differing bitmaps bound how many words differ."""
    c = lambda side, name: F.col(f"{side}.{name}")
    both = c(x, "n") + c(y, "n")
    before = (c(y, "ord") < c(x, "ord")) | ((c(y, "ord") == c(x, "ord")) & (c(y, "line") <= c(x, "line")))
    return ((F.least(c(x, "n"), c(y, "n")) * den >= F.greatest(c(x, "n"), c(y, "n")) * num)
            & before & (c(x, "rid") != c(y, "rid"))
            & (F.least(c(x, "n") - c(x, "p"), c(y, "n") - c(y, "p")) * (num + den) >= both * num)
            & ((c(x, "p") + c(y, "p")) * (num + den) <= both * (den - num))
            & (_differ(x, y) * (num + den) <= both * (den - num)))


def _differ(x: str, y: str) -> Column:
    """At least so many words are in one of the two lines only: bits in which the parities of their words differ.

    ``bits`` has all words of a line on 64 bits; ``odd``, of long lines, those of an odd group, so that two long lines
    are compared on 128 bits, the even group's parities being the difference of both.
    """
    every = F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits"))
    odd = F.col(f"{x}.odd").bitwiseXOR(F.col(f"{y}.odd"))
    return F.coalesce(F.bit_count(odd) + F.bit_count(every.bitwiseXOR(odd)), F.bit_count(every))


def _maybe_in(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``maybe``: false for rows whose keys are not among ``wanted``'s.

    The filter is a bitmap of fixed size (65,536 rows of 64 bits), so that it
    can be broadcast whatever the input; where it is full it lets all rows pass.
    """
    h = F.xxhash64(*keys)
    slot, bit = F.shiftrightunsigned(h, 48).cast("int"), h.bitwiseAND(F.lit(63)).cast("int")
    mask = (wanted.select(slot.alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b"))
            .groupBy("slot").agg(F.bit_or("b").alias("mask")))
    return (df.withColumn("slot", slot).join(F.broadcast(mask), "slot", "left")
            .withColumn("maybe", F.coalesce(F.getbit("mask", bit) == 1, F.lit(False))).drop("slot", "mask"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(ord, k, line): the lines to remove, ``line`` counted from 0; ``k`` tells apart texts that share an id.

    A line goes if an earlier line, in the order (id, line number, text hash),
    has a word set of Jaccard similarity num/den or more, whether that earlier
    line goes itself or not. Lines without words never match.
    """
    num, den = similarity
    doc = _documents(docs, id_col, text_col)
    rank = _rarity(doc)

    def key(h: Column) -> Column:
        """The rank in the upper 16 bits, then the hash: one long per word, sortable by rarity."""
        return F.shiftleft(F.get(rank, _counter(h)).cast("long"), _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    tokens = F.transform(F.transform(F.split(_spaced(F.col("value")), " "), lambda w: F.xxhash64(w)), key)
    words = F.array_remove(F.sort_array(F.array_distinct(tokens)), key(F.xxhash64(F.lit(""))))
    toks = _lines(doc).select("ord", "k", "line", words.alias("t"))
    n = F.size("t")

    def parity(one: Callable[[Column], Column]) -> Column:
        return F.aggregate("t", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(
            F.call_function("shiftleft", one(x), x.bitwiseAND(F.lit(63)).cast("int"))))

    bits = parity(lambda x: F.lit(1).cast("long"))
    odd = F.when(n >= LONG, parity(lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(1).cast("long"))))
    # 32 bits of the hash are enough to meet by: what meets is compared word by word
    low = F.transform(F.slice("t", 1, n - F.ceil(n * num / F.lit(float(den)) - 1e-9).cast("int") + 1),
                      lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))
    # lines without words go as they are read: a filter before would make the words a second time
    lines = materialize(toks.select(
        "ord", "k", "line", F.xxhash64("t").alias("d1"), F.xxhash64(F.lit(7), "t").alias("d2"), n.alias("n"),
        bits.alias("bits"), odd.alias("odd"), low.alias("prefix")), "line-sets").where("n > 0")
    place = F.struct("ord", "line", "k")
    sets = materialize(lines.groupBy("d1", "d2").agg(F.min(F.struct("ord", "line", "k", "n", "bits", "odd", "prefix")).alias("f"),
                                                     F.count("*").alias("copies"))
                       .select("d1", "d2", "f.*", "copies", F.monotonically_increasing_id().alias("rid")), "line-firsts")
    # lines so short that only equal sets reach the similarity need no join
    reps = sets.where(F.col("n") * den >= (F.col("n") + 1) * num)

    def prefixes(some: DataFrame) -> DataFrame:
        return some.select("rid", "ord", "line", "n", "bits", "odd", F.posexplode("prefix").alias("p", "tok"))

    index = prefixes(reps)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The later line's (rid) of each of the (a, b) pairs that reach the similarity on their words."""
        ids = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
        some = materialize(reps.select("rid", "ord", "k", "line").join(ids, "rid", "left_semi"), name + "-lines")
        texts = (_maybe_in(_lines(doc), some, ["ord", "k", "line"]).where("maybe")
                 .select("ord", "k", "line", "value").join(some, ["ord", "k", "line"])
                 .select("rid", place.alias("place"), "value"))
        texts = materialize(texts, name + "-texts")  # whole lines: their words, as arrays, take three times the room
        x, y = texts.toDF("a", "at", "ta"), texts.toDF("b", "bt", "tb")
        both = (pairs.join(x, "a").join(y, "b")
                .select(F.when(F.col("at") > F.col("bt"), F.col("a")).otherwise(F.col("b")).alias("rid"), let(
                    F.struct(F.array_distinct(line_words(F.col("ta"))).alias("wa"),
                             F.array_distinct(line_words(F.col("tb"))).alias("wb")),
                    lambda w: F.struct(F.size(F.array_intersect(w["wa"], w["wb"])).alias("common"),
                                       (F.size(w["wa"]) + F.size(w["wb"])).alias("all"))).alias("n")))
        near = both.where(F.col("n.common") * den >= (F.col("n.all") - F.col("n.common")) * num)
        return materialize(near.select("rid").distinct(), name + "-found")

    # Words that many lines have in their prefix: every such line is compared with the earliest of these first, so that a
    # large group of variants is settled before its lines would all meet each other.
    hot = materialize(index.groupBy("tok").agg(F.count("*").alias("lines")).where(F.col("lines") > STAR).select("tok"), "frequent-prefix-words")
    hot_rows = index.join(hot, "tok")
    earliest = materialize(hot_rows.groupBy("tok").agg(F.min(F.struct("ord", "line", "rid", "n", "p", "bits", "odd")).alias("f"))
                           .select("tok", "f.*"), "earliest-lines")
    star = (hot_rows.alias("x").join(earliest.alias("y"), (F.col("x.tok") == F.col("y.tok")) & _filters("x", "y", num, den))
            .select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")))
    tried = materialize(star.distinct(), "first-pairs")
    settled = verified(tried, "first")

    # All others meet all their earlier partners. One exchange serves both sides of the join: the last bit of a line's number
    # says whether it is settled, and is asked together with its partner's, as a filter of one side would be moved below
    # the exchange.
    done = settled.select("rid", F.lit(1).cast("long").alias("done"))
    marked = reps.join(done, "rid", "left").withColumn("rid", F.shiftleft("rid", 1).bitwiseOR(F.coalesce("done", F.lit(0).cast("long"))))
    rows = prefixes(marked).repartition("tok")
    wanted = F.when(F.col("x.rid").bitwiseAND(F.lit(1)) == 1, F.col("y.rid")).otherwise(F.col("x.rid")) != F.col("y.rid")
    met = rows.alias("x").join(rows.alias("y"), (F.col("x.tok") == F.col("y.tok")) & _filters("x", "y", num, den) & wanted)
    # a pair has one bound of differing words, however many words it met by
    pairs = materialize(met.groupBy(F.shiftright("x.rid", 1).alias("a"), F.shiftright("y.rid", 1).alias("b"))
                        .agg(F.min(_differ("x", "y")).alias("differ")).join(tried, ["a", "b"], "left_anti"), "pairs")

    # Its likeliest partner settles most lines that go; the rest of the pairs are those of lines that it leaves unsettled.
    best = pairs.groupBy("a").agg(F.min(F.shiftleft(F.col("differ").cast("long"), _RID_BITS).bitwiseOR(F.col("b"))).alias("best"))
    likeliest = materialize(best.select("a", F.col("best").bitwiseAND(F.lit((1 << _RID_BITS) - 1)).alias("b")), "likeliest-pairs")
    settled = settled.union(verified(likeliest, "likeliest"))
    again = (pairs.select("a", "b").join(likeliest, ["a", "b"], "left_anti")
             .join(settled.select(F.col("rid").alias("a")), "a", "left_anti"))
    near = settled.union(verified(materialize(again, "remaining-pairs"), "other")).distinct()
    near = reps.join(near, "rid", "left_semi").select("ord", "k", "line")
    # all copies but the first of a set; and the firsts that resemble an earlier line
    repeated = (lines.select("ord", "k", "line", "d1", "d2")
                .join(sets.where("copies > 1").select("d1", "d2", place.alias("f")), ["d1", "d2"])
                .where(place != F.col("f")).select("ord", "k", "line"))
    return repeated.union(near)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids in document order (null last) and texts (null: empty), with a hash that tells apart rows sharing an id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("ord"),
                       F.xxhash64(text).alias("k"), text.alias("text"), F.col(id_col).alias("id"))


def removed_by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(ord, k, removed): per text with duplicates, the sorted numbers of its lines that go."""
    return (duplicate_lines(docs, id_col, text_col, **options).distinct()
            .groupBy("ord", "k").agg(F.array_sort(F.collect_list("line")).alias("removed")))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_lines, n_removed, removed (line numbers, comma-joined)."""
    gone = removed_by_document(docs, id_col, text_col, **options)
    none = F.array().cast("array<int>")
    doc = _documents(docs, id_col, text_col).select("id", "ord", "k", F.size(F.split("text", "\n")).alias("n_lines"))
    removed = F.coalesce("removed", none)
    return (doc.join(gone, ["ord", "k"], "left")
            .select(F.col("id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"),
                    F.size(removed).cast("long").alias("n_removed"), F.array_join(removed, ",").alias("removed")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the later lines cut out of ``text_col``; all rows and columns stay.

    Null texts stay null. A text that loses all lines becomes empty. A line
    number beyond the texts of other rows touches nothing: the join is by id and
    text. Repeated rows (same id and text) are cut alike. Empty tables give none.
    """
    gone = materialize(removed_by_document(docs, id_col, text_col, **options), "removed-lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("ord"),
                        F.xxhash64(text).alias("k"))
    # texts that lose no line need not move
    keyed = _maybe_in(keyed, gone, ["ord", "k"])
    lines = F.split(F.col("row")[text_col], "\n")
    kept = F.array_join(F.filter(F.transform(lines, lambda v, i: F.when(~F.array_contains("removed", i), v)),
                                 lambda v: v.isNotNull()), "\n")
    cut = (keyed.where("maybe").join(gone, ["ord", "k"], "left")
           .select(*(F.when(F.col("removed").isNull(), F.col("row")[c]).otherwise(kept).alias(c) if c == text_col
                     else F.col("row")[c].alias(c) for c in docs.columns)))
    return keyed.where(~F.col("maybe")).select("row.*").union(cut)
