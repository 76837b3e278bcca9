"""Strict JSON-line parsing and JavaScript-style key identity.

Spark's JSON readers stop after the first complete value, so ``{"id":1} xyz``
parses. A line is accepted here only when it is exactly one JSON value: it is
parsed twice, once wrapped as ``[line]`` and once as ``{"w":line}``. Trailing
text that closes one wrapper early can never close the other, so both parses
succeed (and the array holds one element) only for a single clean value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tackroom.constants import JS_WHITESPACE_CLASS

NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def is_blank(line: Column) -> Column:
    """True when the line holds only whitespace (JavaScript ``trim`` rules)."""
    return ~line.rlike(f"[^{JS_WHITESPACE_CLASS}]")


def strict_parse(line: Column) -> Column:
    """Variant of the line when it is exactly one JSON value, else NULL."""
    as_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    as_field = F.try_parse_json(F.concat(F.lit('{"w":'), line, F.lit("}")))
    one = F.array_size(as_array.cast("array<variant>")) == 1
    return F.when(as_array.isNotNull() & as_field.isNotNull() & one,
                  F.variant_get(as_array, "$[0]", "variant"))


# Spark's JSON parser refuses longer texts, longer numbers and deeper nesting.
MAX_TEXT, MAX_NUMBER, MAX_DEPTH = 20_000_000, 1000, 1000


def beyond_parser(line: Column) -> Column:
    """True for a line that may be valid JSON beyond the parser's limits (it need not be valid)."""
    opening = F.length(line) - F.length(F.translate(line, "[{", ""))
    return ((F.length(line) > MAX_TEXT) | (opening > MAX_DEPTH) | line.rlike(f"[0-9]{{{MAX_NUMBER}}}"))


def record_id(rec: Column, field: str = "id") -> Column:
    """The ``field`` member of an object variant (NULL for non-objects)."""
    return F.try_variant_get(rec, f"$.{field}", "variant")


def id_identity(idv: Column, unique_token: Column) -> Column:
    """JavaScript ``Set`` identity of a parsed id as a struct (kclass, knum, kstr).

    Numbers compare by value (``5`` equals ``5.0``; cast to double reproduces
    the precision of a JS number), strings by text, booleans by value, and an
    object or array id is only ever equal to itself, so it takes
    ``unique_token`` (a serialised order key) as its identity.
    """
    t = F.schema_of_variant(idv)
    is_num = t.isin(*NUMERIC_TYPES) | t.startswith("DECIMAL")
    kclass = (F.when(idv.isNull() | F.is_variant_null(idv), F.lit(None))
              .when(is_num, F.lit("num"))
              .when(t == "STRING", F.lit("str"))
              .when(t == "BOOLEAN", F.lit("bool"))
              .otherwise(F.lit("ref")))
    knum = F.when(kclass == "num", F.variant_get(idv, "$", "double"))
    kstr = (F.when(kclass.isin("str", "bool"), F.variant_get(idv, "$", "string"))
            .when(kclass == "ref", unique_token))
    return F.struct(kclass.alias("kclass"), knum.alias("knum"), kstr.alias("kstr"))


def js_truthy_id(key: Column) -> Column:
    """JavaScript truthiness of an id given its identity struct."""
    return (F.when(key.kclass == "num", (key.knum != 0) & ~F.isnan(key.knum))
            .when(key.kclass == "str", key.kstr != "")
            .when(key.kclass == "bool", key.kstr == "true")
            .when(key.kclass == "ref", F.lit(True))
            .otherwise(F.lit(False)))
