"""A schema found in cleaned lines, checked.

Every top-level field's values are counted by kind in one aggregation over the
lines' variants. Kinds meet in a lattice: null is below all, whole numbers are below
numbers, and any other two meet in text, so a field of numbers and text is text
and every value keeps its digits; a field of nulls only is text. Objects and arrays are merged by
Spark's own schema of variants; with anything else they meet in text, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.functions.jsonline import is_blank
from tackroom.functions.records import load_records

NULL, WHOLE, NUMBER, TEXT, BOOLEAN, NESTED = "null", "whole", "number", "text", "boolean", "nested"
_TYPES = {WHOLE: "bigint", NUMBER: "double", TEXT: "string", BOOLEAN: "boolean"}


def _kinds(lines: DataFrame, line_col: str) -> DataFrame:
    """(field, kind, value) of every member of every line that is an object."""
    rec = lines.where(~is_blank(F.col(line_col))).select(F.try_parse_json(line_col).alias("r"))
    members = rec.where(F.schema_of_variant("r").startswith("OBJECT")) \
        .select(F.explode(F.try_variant_get("r", "$", "map<string,variant>")).alias("field", "value"))
    shape = F.schema_of_variant("value")
    whole = F.try_variant_get("value", "$", "double") == F.floor(F.try_variant_get("value", "$", "double"))
    small = F.abs(F.try_variant_get("value", "$", "double")) < 9.2e18
    kind = (F.when(F.is_variant_null("value") | F.col("value").isNull(), F.lit(NULL))
            .when(shape.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(WHOLE))
            # 5.0 is a whole number, as it is to the load
            .when((shape.isin("DOUBLE", "FLOAT") | shape.startswith("DECIMAL")) & whole & small, F.lit(WHOLE))
            .when(shape.isin("DOUBLE", "FLOAT") | shape.startswith("DECIMAL"), F.lit(NUMBER))
            .when(shape == "STRING", F.lit(TEXT)).when(shape == "BOOLEAN", F.lit(BOOLEAN)).otherwise(F.lit(NESTED)))
    return members.select("field", kind.alias("kind"), "value")


def _meet(kinds: set[str]) -> str:
    """The least kind that holds all of these."""
    some = kinds - {NULL}
    if len(some) == 1:
        return next(iter(some))
    return NUMBER if some == {WHOLE, NUMBER} else TEXT


def _found(lines: DataFrame, line_col: str) -> dict[str, tuple[str, set[str]]]:
    """Per field its type and kinds: one row a field and kind reaches the driver."""
    rows = _kinds(lines, line_col).groupBy("field", "kind").agg(
        F.schema_of_variant_agg(F.when(F.col("kind") == NESTED, F.col("value"))).alias("shape")).collect()
    kinds: dict[str, set[str]] = {}
    shapes = {}
    for r in rows:
        kinds.setdefault(r["field"], set()).add(r["kind"])
        if r["kind"] == NESTED:
            shapes[r["field"]] = r["shape"].replace("OBJECT<", "STRUCT<")
    out = {}
    for field in sorted(kinds):
        kind = _meet(kinds[field])
        out[field] = (shapes[field].lower() if kind == NESTED and "VARIANT" not in shapes[field] and "VOID" not in shapes[field]
                      else _TYPES.get(kind, "variant"), kinds[field])
    return out


def infer_types(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(field, type, seen, changed, n_lines): the type a load gives each field, the kinds of its values, whether values that are not
    null differ in kind, and the number of lines that are not blank."""
    found = _found(lines, line_col)
    n = lines.where(~is_blank(F.col(line_col))).count()
    rows = [(f, t, ", ".join(sorted(k)), len(k - {NULL}) > 1, n) for f, (t, k) in found.items()]
    return lines.sparkSession.createDataFrame(rows, "field string, type string, seen string, changed boolean, n_lines long")


def load_inferred(lines: DataFrame, line_col: str = "line", rejects: str | None = None) -> DataFrame:
    """Typed rows of ``lines`` with the schema found in them; blank lines are no records. By the lattice every value of a field fits; a line
    that is no object is a misfit, which fails the job or goes to ``rejects``."""
    schema = ", ".join(f"`{f}` {t}" for f, (t, _) in _found(lines, line_col).items())
    return load_records(lines.where(~is_blank(F.col(line_col))), schema or "`id` string", line_col, rejects)
