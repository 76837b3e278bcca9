"""Typed records from cleaned JSON lines: nothing turns into NULL unnoticed.

Values are read through the variant that the clean step accepted, so that
``5.0`` and ``"5"`` are the number 5 where a number is wanted, and 5 is the text
``5`` where text is wanted. What does not fit its field's type is a defect: the
load fails, or the record goes to a reject table with the names of the fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType,
)

from tackroom.functions.columns import once, settled
from tackroom.functions.fold import variant_text

_INTEGERS = (LongType, IntegerType, ShortType, ByteType)
_NUMBER_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _shape(v: Column) -> tuple[Column, Column, Column]:
    """(schema, whether it is a number, its text if it is one) of a variant."""
    shape = F.schema_of_variant(v)
    number = shape.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    return shape, number, F.when(shape == "STRING", F.try_variant_get(v, "$", "string"))


def _whole(v: Column, number: Column, numeric_text: Column, name: str) -> Column:
    """An integer from a number or its text; a fraction, however small, does not fit."""
    def read(digits: Column) -> Column:
        head = F.regexp_extract(digits, r"^([+-]?[0-9]*)", 1)
        head = F.when(head.isin("", "+", "-"), F.concat(head, F.lit("0"))).otherwise(head)
        # written with an exponent: a double, so whole if it equals its floor
        limit = F.when(number, F.lit(9.2e18)).otherwise(F.lit(float(1 << 53)))
        power = once(digits.try_cast("double"), lambda d: F.when((d == F.floor(d)) & (F.abs(d) < limit), d.try_cast("long")))
        return F.when(digits.rlike(r"^[+-]?([0-9]+([.]0*)?|[.]0+)$"), head.try_cast(name)) \
                .when(digits.rlike("[eE]"), power.try_cast(name))

    return once(F.when(number, F.try_variant_get(v, "$", "string")).otherwise(numeric_text), read)


def _listed(v: Column) -> Column:
    """The elements of an array variant, NULL for anything else."""
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def _member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, _path(name), "variant")


def _typed(v: Column, kind: DataType) -> Column:
    """The variant as ``kind``; NULL if it is missing, null or does not fit (a member of an object or array by itself)."""
    if isinstance(kind, StructType):
        fields = [_typed(_member(v, f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(_listed(v), lambda e: _typed(e, kind.elementType))
    shape, number, text = _shape(v)
    numeric_text, name = F.when(text.rlike(_NUMBER_TEXT), text), kind.simpleString()
    if isinstance(kind, _INTEGERS):
        return _whole(v, number, numeric_text, name)
    if isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return F.when(number, F.try_variant_get(v, "$", name)).otherwise(numeric_text.try_cast(name))
    if isinstance(kind, BooleanType):
        return F.when(shape == "BOOLEAN", F.try_variant_get(v, "$", "boolean")) \
                .when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
    if isinstance(kind, StringType):
        return F.when(number | shape.isin("STRING", "BOOLEAN"), variant_text(v))
    return F.try_variant_get(v, "$", name)


_MISFIT = "array<struct<field:string,value:string>>"


def _misfits(v: Column, kind: DataType, path: Column) -> Column:
    """(field, value) of everything in the variant that is there, not null and does not fit."""
    there = v.isNotNull() & ~F.is_variant_null(v)
    none = F.array().cast(_MISFIT)
    wrong = F.array(F.struct(path.alias("field"), F.to_json(v).alias("value"))).cast(_MISFIT)
    if isinstance(kind, StructType):
        inner = F.concat(none, *[_misfits(_member(v, f.name), f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields])
        return F.when(~there, none).when(F.schema_of_variant(v).startswith("OBJECT"), inner).otherwise(wrong)
    if isinstance(kind, ArrayType):
        inner = F.flatten(F.transform(_listed(v), lambda e, i: _misfits(
            e, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.when(~there, none).when(F.schema_of_variant(v).startswith("ARRAY"), inner).otherwise(wrong)
    return F.when(there & _typed(v, kind).isNull(), wrong).otherwise(none)


def typed_records(lines: DataFrame, schema: StructType | str, line_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """The fields of ``schema`` from JSON object lines; ``_misfits``: (field, value) of all that does not fit, members of
    objects and arrays as ``a.b`` and ``a[0]``; ``_bad``: the top-level fields among them; and the columns ``keep``."""
    fields = _schema(lines.sparkSession, schema).fields
    # each step is settled: a filter on the last one would otherwise repeat the parse for every use of a field
    rec = settled(lines.select(*keep, line_col, F.try_parse_json(line_col).alias("_rec")))
    members = rec.select(*keep, line_col, "_rec", *[_member(F.col("_rec"), f.name).alias(f"_v{i}") for i, f in enumerate(fields)])
    typed = settled(settled(members).select(*keep, line_col, "_rec", *[F.col(f"_v{i}") for i in range(len(fields))],
                                            *[_typed(F.col(f"_v{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)]))

    def judged(i: int, f) -> Column:
        if isinstance(f.dataType, (StructType, ArrayType)):
            return _misfits(F.col(f"_v{i}"), f.dataType, F.lit(f.name))
        there = F.col(f"_v{i}").isNotNull() & ~F.is_variant_null(F.col(f"_v{i}"))
        wrong = F.array(F.struct(F.lit(f.name).alias("field"), F.to_json(F.col(f"_v{i}")).alias("value"))).cast(_MISFIT)
        return F.when(there & F.col(f"`{f.name}`").isNull(), wrong).otherwise(F.array().cast(_MISFIT))

    each = [judged(i, f) for i, f in enumerate(fields)]
    no_object = F.col("_rec").isNull() | ~F.schema_of_variant("_rec").startswith("OBJECT")
    whole = F.array(F.struct(F.lit("(record)").alias("field"), F.col(line_col).alias("value"))).cast(_MISFIT)
    out = settled(typed.select(*keep, line_col, "_rec", *[F.col(f"`{f.name}`") for f in fields], *[e.alias(f"_m{i}") for i, e in enumerate(each)]))
    bad = F.array_compact(F.array(*[F.when(F.size(f"_m{i}") > 0, F.lit(f.name)) for i, f in enumerate(fields)]))
    return out.select(*keep, F.col(line_col).alias("_line"), *[F.col(f"`{f.name}`") for f in fields],
                      F.when(no_object, F.array(F.lit("(record)"))).otherwise(bad).alias("_bad"),
                      F.when(no_object, whole).otherwise(F.concat(*[F.col(f"_m{i}") for i in range(len(fields))])).alias("_misfits"))


def load_records(lines: DataFrame, schema: StructType | str, line_col: str = "line", rejects: str | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows of ``lines``. A value that does not fit its field fails the job; with ``rejects`` the
    record is appended to that table (``line``, ``fields``, ``misfits``) and the rest is returned."""
    typed = typed_records(lines, schema, line_col, keep)
    names = [*keep, *[f"`{f.name}`" for f in _schema(lines.sparkSession, schema).fields]]
    if rejects is not None:
        typed.where(F.size("_bad") > 0).select(F.col("_line").alias("line"), F.col("_bad").alias("fields"), F.col("_misfits").alias("misfits")) \
             .write.mode("append").parquet(rejects)
        return typed.where(F.size("_bad") == 0).select(*names)
    # a filter is not pruned, whichever columns are read later
    message = F.concat(F.lit("value does not fit its type in "), F.array_join("_bad", ", "), F.lit(": "), F.col("_line"))
    return typed.where(F.when(F.size("_bad") == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).select(*names)
