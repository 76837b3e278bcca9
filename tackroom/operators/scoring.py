"""Scoring and ranking.

Greedy top-K: at position p the pick is the best row by P(p) among rows not
already picked, ties to the lowest index. A group of up to ``MAX_RACE`` rows is
one array: its rows are shuffled once, and the greedy pass walks the array.
A larger group is never collected: fewer than K rows are ever picked, so the
pick is always among the K best rows for P(p), and per (group, position) only
those K candidates are kept, with a partial ``WindowGroupLimit`` that runs
before the shuffle; the greedy pass then walks at most K*K candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS, DEFAULT_TOP_K, RANK_ALL_EQUAL, RANK_MAX, RANK_MIN
from tackroom.functions.columns import GROUP_KEY, number_text, once, with_group_key
from tackroom.operators.skew import split_by_group_size

MAX_RACE = 10_000  # rows of a group that is ranked as one array


def _groups(df: DataFrame, group: Sequence[str]):
    """The group key column; an ungrouped call ranks the whole input as one group."""
    return [GROUP_KEY], with_group_key(df, list(group)), not group


# Python's float() on text: digits with single underscores between them, an optional exponent, or a special value.
_DIGITS = "[0-9]+(_[0-9]+)*"
FLOAT_TEXT = (rf"(?i)^[+-]?(({_DIGITS}([.]({_DIGITS})?)?|[.]{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)$")


# White space to Python's str.strip().
_SPACE = r"[\t-\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def python_float(c: Column) -> Column:
    """Text as the double that Python's float() gives; NULL where that would fail."""
    text = F.regexp_replace(c, f"^{_SPACE}|{_SPACE}$", "")
    return F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def python_text(c: Column, kind: str) -> Column:
    """A scalar as Python's str() writes it: ``True``, ``1e+16``, ``10000000.0``."""
    if kind == "boolean":
        return F.initcap(c.cast("string"))
    if kind not in ("double", "float"):
        return c.cast("string")
    shown = number_text(c, lowest=-4, beyond=16, exponent_digits=2, whole_suffix=".0")
    return F.when(F.isnan(c), F.lit("nan")).when(c == float("inf"), F.lit("inf")).when(c == float("-inf"), F.lit("-inf")).otherwise(shown)


def cast_string_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """P10: listed fields that exist become text as Python writes it (NULL stays NULL)."""
    kinds = dict(df.dtypes)
    return df.select(*[python_text(F.col(c), kinds[c]).alias(c) if c in fields else F.col(c) for c in df.columns])


def cast_numeric_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Listed text fields become double; text that does not parse becomes
    NULL here and is kept verbatim in ``<field>_raw`` (a column has one type)."""
    out = []
    for c in df.columns:
        if c in fields:
            dt = df.schema[c].dataType.simpleString()
            if dt == "string":
                num = python_float(F.col(c))
                out += [num.alias(c), F.when(num.isNull() & F.col(c).isNotNull(), F.col(c)).alias(c + "_raw")]
            else:
                out += [F.col(c).cast("double").alias(c), F.lit(None).cast("string").alias(c + "_raw")]
        else:
            out.append(F.col(c))
    return df.select(*out)


def class_probs(scores: Column, labels: Sequence[str] = CLASS_LABELS) -> Column:
    """M1: label -> probability map by position; fewer scores than labels fails."""
    n = len(labels)
    checked = F.when(F.size(scores) >= n, scores).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {n} scores, got "), F.size(scores).cast("string"))))
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.slice(checked, 1, n))


def prob_of(probs: Column, label: str) -> Column:
    """map lookup with default 0.0."""
    return F.coalesce(F.try_element_at(probs, F.lit(label)), F.lit(0.0))


def win_place_top3(df: DataFrame, probs: str = "class_probs") -> DataFrame:
    """M2: cumulative P(1), P(1)+P(2), P(1)+P(2)+P(3)."""
    p = F.col(probs)
    win = prob_of(p, "1")
    place = win + prob_of(p, "2")
    return df.withColumn("win_prob", win).withColumn("place_prob", place) \
             .withColumn("top3_prob", place + prob_of(p, "3"))


def relative_rank(df: DataFrame, prob: str, group: Sequence[str] = ()) -> DataFrame:
    """``round_half_even(1 + (p-min)*99/(max-min))``; all equal -> 100.

    min/max come from a grouped aggregate (partial, so a huge group is
    combined map-side) joined back on the group key; AQE broadcasts the
    per-group table when it is small and splits skewed partitions otherwise.
    """
    g, df, whole = _groups(df, group)
    p = F.col(prob)
    bounds = df.groupBy(*g).agg(F.min(prob).alias("_mn"), F.max(prob).alias("_mx"))
    # one row when ungrouped: a proven size, so broadcast it explicitly
    j = df.join(F.broadcast(bounds) if whole else bounds, g, "inner")
    span = F.col("_mx") - F.col("_mn")
    scaled = F.lit(RANK_MIN) + (p - F.col("_mn")) * F.lit(RANK_MAX - RANK_MIN) / span
    rank = F.when(span == 0, F.lit(RANK_ALL_EQUAL)).otherwise(F.bround(scaled, 0).cast("int"))
    return j.withColumn("rel_rank", rank).drop("_mn", "_mx", GROUP_KEY)


def greedy_top_k(df: DataFrame, probs: str, idx: str, group: Sequence[str] = (),
                 k: int = DEFAULT_TOP_K, max_rows: int = MAX_RACE) -> DataFrame:
    """(group..., position, idx, prob) for positions 1..min(k, n).

    ``probs`` is the label->probability map; a position without a class
    scores 0.0, which leaves the lowest remaining index. Groups of more than
    ``max_rows`` rows, and the whole of an ungrouped input, are pruned to
    their candidates first.
    """
    if k < 1:
        return df.select(*group, F.lit(None).cast("int").alias("position"), F.col(idx),
                         F.lit(None).cast("double").alias("prob")).limit(0)
    small, hot = split_by_group_size(df, group, max_rows) if group else (None, df)
    parts = [picked(part, probs, idx, group, k) for part, picked in ((small, _picks_of_rows), (hot, _picks_of_candidates))
             if part is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _picks_of_rows(df: DataFrame, probs: str, idx: str, group: Sequence[str], k: int) -> DataFrame:
    """Greedy picks of groups that fit an array: one shuffle, in which a row is itself and not one row a position."""
    g, df, _ = _groups(df, group)
    by_pos = F.array(*[prob_of(F.col(probs), str(i)) for i in range(1, k + 1)])
    per_group = df.groupBy(*g).agg(F.collect_list(F.struct(F.col(idx).alias("_idx"), by_pos.alias("by_pos"))).alias("_c"))

    def best(chosen, pos):
        left = F.filter(F.col("_c"), lambda c: ~F.array_contains(chosen, c["_idx"]))
        return F.array_min(F.transform(left, lambda c: F.struct((-F.element_at(c["by_pos"], pos)).alias("neg"), c["_idx"].alias("_idx"))))

    return _greedy(per_group.withColumn("_n", F.size("_c")), best, idx, group, k)


def _picks_of_candidates(df: DataFrame, probs: str, idx: str, group: Sequence[str], k: int) -> DataFrame:
    """Greedy picks of groups of any size, from the K best rows of each position."""
    g, df, _ = _groups(df, group)
    p = F.col(probs)
    pos_probs = F.array(*[F.struct(F.lit(i).alias("pos"), prob_of(p, str(i)).alias("prob"))
                          for i in range(1, k + 1)])
    long_ = df.select(*g, F.col(idx).alias("_idx"), F.inline(pos_probs))
    w = Window.partitionBy(*g, "pos").orderBy(F.col("prob").desc(), F.col("_idx").asc())
    cands = long_.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    per_group = cands.groupBy(*g).agg(F.sort_array(F.collect_list(
        F.struct("pos", (-F.col("prob")).alias("neg"), "_idx"))).alias("_c"))

    def best(chosen, pos):
        return F.element_at(F.filter(F.col("_c"), lambda c: (c["pos"] == pos) & ~F.array_contains(chosen, c["_idx"])), 1)

    return _greedy(per_group.join(sizes, g, "inner"), best, idx, group, k)


def _greedy(per_group: DataFrame, best: Callable[[Column, Column], Column], idx: str, group: Sequence[str], k: int) -> DataFrame:
    """One row a pick: ``best(chosen, position)`` is the struct (neg, _idx) of the best row that is not among the chosen."""
    def step(acc, pos):
        pick = best(acc["chosen"], pos)
        return once(pick, lambda b: F.struct(
            F.array_append(acc["chosen"], b["_idx"]).alias("chosen"),
            F.array_append(acc["picks"], F.struct(pos.alias("position"), b["_idx"].alias("idx"), (-b["neg"]).alias("prob"))).alias("picks")))

    empty_long = F.filter(F.array(F.lit(0).cast("long")), lambda x: F.lit(False))
    empty_pick = F.filter(F.array(F.struct(F.lit(0).alias("position"), F.lit(0).cast("long").alias("idx"),
                                           F.lit(0.0).alias("prob"))), lambda x: F.lit(False))
    init = F.struct(empty_long.alias("chosen"), empty_pick.alias("picks"))
    steps = F.sequence(F.lit(1), F.least(F.lit(k), F.col("_n").cast("int")))
    picks = F.aggregate(steps, init, step, lambda acc: acc["picks"])
    out = per_group.select(GROUP_KEY, F.inline(picks))
    return out.select(*[F.col(f"{GROUP_KEY}.{c}").alias(c) for c in group],
                      "position", F.col("idx").alias(idx), "prob")


def race_card(df: DataFrame, scores: str, idx: str, group: Sequence[str] = ()) -> DataFrame:
    """M3 (per-row table): 0-based index and the number shown (from 1), win/place/top-3 and the relative rank."""
    with_probs = df.withColumn("class_probs", class_probs(F.col(scores))).withColumn("number", F.col(idx) + 1)
    return relative_rank(win_place_top3(with_probs), "win_prob", group).drop("class_probs")


def finishers(df: DataFrame, scores: str, idx: str, group: Sequence[str] = (), k: int = DEFAULT_TOP_K) -> DataFrame:
    """M3 (finishers table): the greedy pick of each position, with the number shown (from 1)."""
    picks = greedy_top_k(df.withColumn("class_probs", class_probs(F.col(scores))), "class_probs", idx, group, k)
    return picks.withColumn("number", F.col(idx) + 1)
