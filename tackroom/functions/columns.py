"""Small scalar helpers used by the reshaping operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def falsy_to_null(c: Column, kind: str = "string") -> Column:
    """``x || null``: the empty string, zero and false become NULL."""
    if kind == "string":
        return F.nullif(c, F.lit(""))
    if kind == "number":
        return F.nullif(c, F.lit(0))
    if kind == "boolean":
        return F.when(c, c)
    raise ValueError(kind)


def first_elem(arr: Column) -> Column:
    """First element of an array, NULL for a NULL or empty array (never fails)."""
    return F.get(arr, 0)


def prize_total(prize: Column) -> Column:
    """Sum of the amounts in a prize text such as ``'1200.0 + 300'``."""
    parts = F.regexp_extract_all(prize, F.lit(r"(-?\d+(?:\.\d+)?)"), 1)
    return F.aggregate(parts, F.lit(0.0).cast(T.DoubleType()),
                       lambda acc, x: acc + x.cast("double"))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it: keeps long expressions small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed before anything later reads them: neither a filter on them nor a column made of
    them is pushed into their expressions, which would evaluate those once for each use."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def number_text(c: Column, lowest: int, beyond: int, exponent_digits: int, whole_suffix: str) -> Column:
    """A finite double by its fewest digits: plain while its power of ten is from ``lowest`` to below ``beyond``, else
    with an exponent of at least ``exponent_digits`` digits. A plain whole number ends in ``whole_suffix``."""
    def parts(s: Column) -> Column:   # 123.5, 10000.0 or 1.25E10
        return F.struct(F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
                        F.regexp_extract(s, r"^-?([0-9]+)[.]", 1).alias("before"),
                        F.regexp_replace(F.regexp_extract(s, r"[.]([0-9]+)", 1), "0+$", "").alias("behind"),
                        F.coalesce(F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0)).alias("power"))

    def scaled(p: Column) -> Column:  # without leading zeros: the digits, and the power of ten of the first
        joined = F.concat(p["before"], p["behind"])
        digits = F.regexp_replace(joined, "^0+", "")
        return F.struct(p["sign"].alias("sign"), digits.alias("digits"),
                        (p["power"] + F.length(p["before"]) - 1 - (F.length(joined) - F.length(digits))).alias("e"))

    def shown(p: Column) -> Column:
        digits, e = p["digits"], p["e"]
        whole = F.rpad(F.substring(digits, F.lit(1), e + 1), e + 1, F.lit("0"))
        rest = F.regexp_replace(F.substring(digits, e + 2, F.length(digits)), "0+$", "")
        plain = F.when(e >= 0, F.concat(whole, F.when(rest == "", F.lit(whole_suffix)).otherwise(F.concat(F.lit("."), rest)))) \
                 .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), F.regexp_replace(digits, "0+$", "")))
        tail = F.regexp_replace(F.substring(digits, F.lit(2), F.length(digits)), "0+$", "")
        power = F.abs(e).cast("string")
        short = F.concat(F.substring(digits, 1, 1), F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("."), tail)),
                         F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")),
                         F.lpad(power, F.greatest(F.lit(exponent_digits), F.length(power)), F.lit("0")))
        return F.concat(p["sign"], F.when(digits == "", F.lit("0" + whole_suffix)).when((e >= lowest) & (e < beyond), plain).otherwise(short))

    return once(c.cast("string"), lambda s: once(parts(s), lambda p: once(scaled(p), shown)))


def js_number_text(c: Column) -> Column:
    """A finite double as JavaScript writes it: ``1000``, ``0.1``, ``1e+21``, ``1e-7``; no sign for zero."""
    return F.when(c == 0, F.lit("0")).otherwise(number_text(c, lowest=-6, beyond=21, exponent_digits=1, whole_suffix=""))


def round6(c: Column) -> Column:
    return F.round(c, 6)


def percent_text(p: Column) -> Column:
    """Display text of a probability with one decimal, e.g. ``'12.3%'``.

    Display only: Spark formats exact ties half-up, so compare the numeric
    column, never this text.
    """
    return F.format_string("%.1f%%", p * 100)


GROUP_KEY = "_gk"


def with_group_key(df, cols):
    """Add ``_gk = struct(cols...)``: one non-NULL key column in which a NULL
    group value is an ordinary value (struct equality treats NULL fields as
    equal). Grouping, windows and joins on it are plain equi-operations, so a
    NULL group stays one group without NULL-safe join rewrites, and the
    partitioning on ``_gk`` is reused by every later step."""
    return df.withColumn(GROUP_KEY, F.struct(*[F.col(c) for c in cols]))
