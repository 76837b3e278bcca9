"""Ordered career fold.

Rules, element by element in array order:
1. an element with a non-null year starts a new anchor and is emitted;
2. an element with a null year and a truthy prize, after an anchor, appends
   its prize to the anchor's (``a + ' + ' + b``, or just ``b`` when the
   anchor's prize is falsy); nothing is emitted;
3. anything else (null-year rows before the first anchor, falsy prizes) is
   dropped; a NULL array folds to an empty one.

``fold_prizes`` is the nested form: higher-order functions within the record, so
it is row-local (no shuffle) and runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tackroom.constants import PRIZE_SEPARATOR
from tackroom.functions.columns import js_number_text


def prize_truthy(p: Column) -> Column:
    return p.isNotNull() & (p != "")


def variant_truthy(v: Column) -> Column:
    """JavaScript truthiness of a variant: not null, false, 0, NaN or the empty text."""
    shape = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
            .when(shape == "STRING", F.try_variant_get(v, "$", "string") != "")
            .when(shape == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(number.isNotNull(), (number != 0) & ~F.isnan(number))
            .otherwise(F.lit(True)))


def variant_text(v: Column) -> Column:
    """A variant as JavaScript writes it in a text: ``1200.0`` and ``1.2e3`` are ``1200``; NULL stays NULL. Whole
    numbers written without point or exponent keep all their digits."""
    shape = F.schema_of_variant(v)
    return F.when(shape.isin("DOUBLE", "FLOAT") | shape.startswith("DECIMAL"), js_number_text(F.try_variant_get(v, "$", "double"))) \
            .otherwise(F.try_variant_get(v, "$", "string"))


def fold_prizes(arr: Column, year: str = "raceYear", prize: str = "prize", variant: bool = False) -> Column:
    """Fold an ``array<struct>`` per the rules above; ``prize`` is text, or with ``variant`` a variant whose
    numbers count as falsy when zero and are written as JavaScript does. The result's prize is text.

    Linear in the array: the places of the anchors first, then each anchor takes
    the slice of elements up to the next one.
    """
    if variant:
        arr = F.transform(arr, lambda x: x.withField("_truthy", variant_truthy(x[prize])).withField(prize, variant_text(x[prize])))
    truthy = (lambda x: x["_truthy"]) if variant else (lambda x: prize_truthy(x[prize]))

    def one(arr: Column, i: Column, following: Column) -> Column:
        anchor = F.get(arr, i)
        tail = F.filter(F.slice(arr, i + 2, following - i - 1), truthy)
        text = F.array_join(F.transform(tail, lambda x: x[prize]), PRIZE_SEPARATOR)
        folded = (F.when(F.size(tail) == 0, anchor[prize])
                  .when(truthy(anchor), F.concat(anchor[prize], F.lit(PRIZE_SEPARATOR), text))
                  .otherwise(text))
        anchor = anchor.withField(prize, folded)
        return anchor.dropFields("_truthy") if variant else anchor

    def fold(arr: Column) -> Column:
        anchors = F.array_compact(F.transform(arr, lambda x, i: F.when(x[year].isNotNull(), i)))
        return F.element_at(F.transform(F.array(anchors), lambda places: F.transform(
            places, lambda i, j: one(arr, i, F.coalesce(F.get(places, j + 1), F.size(arr))))), 1)

    # the outer transforms evaluate the array and the places once
    return F.coalesce(F.element_at(F.transform(F.array(arr), fold), 1), F.array())


def fold_prize_rows(df, group_cols, order_col: str, year_col: str, prize_col: str,
                    chunk: int = 1 << 16):
    """Tabular form of the fold: one row per element in, one row per anchor out.

    Columns out: ``group_cols``, ``order_col`` (the anchor's), ``year_col``,
    ``prize_col`` (folded). The anchor of each element is the last anchor at
    or before it, a segmented "running last". To keep a group that holds a
    large share of all rows from landing in one task, the scan is chunked:

    1. per (group, chunk of ``chunk`` consecutive order values): the last
       anchor in the chunk (partial aggregation, skew-safe);
    2. the carry into each chunk: running max over the much smaller chunk
       table;
    3. per element: running max within its own chunk (window partitions are
       bounded by ``chunk`` rows), falling back to the carry;
    4. appended prizes are string-aggregated per anchor in element order.
    """
    from pyspark.sql import Window

    from tackroom.functions.columns import GROUP_KEY, with_group_key

    from tackroom.operators.skew import rank_in_group

    k = GROUP_KEY  # one struct key: a NULL group is one group, joins stay plain equi-joins
    # exact ranks as places: repeated and NULL order values fold as the sorted array of the nested form does
    df = rank_in_group(df.select(*group_cols, order_col, year_col, prize_col), group_cols,
                       [order_col, year_col, prize_col], name="_place")
    shown, order_col = order_col, "_place"
    o, y, p = F.col(order_col), F.col(year_col), F.col(prize_col)
    rows = with_group_key(df, group_cols).select(
        k, shown, order_col, year_col, prize_col, F.floor(o / F.lit(chunk)).alias("_chunk"),
        F.when(y.isNotNull(), o).alias("_anchor"))
    last_in_chunk = rows.groupBy(k, "_chunk").agg(F.max("_anchor").alias("_last"))
    carry_w = Window.partitionBy(k).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_chunk.select(k, "_chunk", F.max("_last").over(carry_w).alias("_carry"))
    in_chunk_w = Window.partitionBy(k, "_chunk").orderBy(order_col) \
                       .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = rows.join(carry, [k, "_chunk"], "left") \
              .withColumn("_seg", F.coalesce(F.max("_anchor").over(in_chunk_w), F.col("_carry")))
    tails = (seg.where(y.isNull() & F.col("_seg").isNotNull() & prize_truthy(p))
             .groupBy(k, "_seg")
             .agg(F.sort_array(F.collect_list(F.struct(o.alias("o"), p.alias("p")))).alias("_t"))
             .select(k, F.col("_seg").alias(order_col),
                     F.array_join(F.transform("_t", lambda e: e["p"]), PRIZE_SEPARATOR).alias("_tail")))
    anchors = seg.where(y.isNotNull()).select(k, shown, order_col, year_col, p.alias("_p0"))
    out = anchors.join(tails, [k, order_col], "left")
    folded = (F.when(F.col("_tail").isNull(), F.col("_p0"))
              .when(prize_truthy(F.col("_p0")),
                    F.concat(F.col("_p0"), F.lit(PRIZE_SEPARATOR), F.col("_tail")))
              .otherwise(F.col("_tail")))
    g = [F.col(f"{k}.{c}").alias(c) for c in group_cols]
    return out.select(*g, shown, year_col, folded.alias(prize_col))
