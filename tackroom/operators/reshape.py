"""Reshaping of nested records.

Everything here is row-local: nested arrays are rebuilt with ``transform`` /
``aggregate`` inside the row, never by exploding and re-grouping, so these
operators add no shuffle and run inside the scan's stage in the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tackroom.constants import STATUS_OK
from tackroom.functions.columns import falsy_to_null, first_elem
from tackroom.functions.fold import fold_prizes


def _path(x: Column, path: str) -> Column:
    out = x
    for part in path.split("."):
        out = out[part]
    return out


# How each field is derived: (source path, rule). Rules: "pass" keeps the
# value, "falsy" applies ``x || null``, "string"/"double" cast (ANSI: a bad
# value fails the job), "const:<text>" is a constant.
# --- fixed values: response paths and record field names, in record order ---
RACES_MAPPING: Mapping[str, tuple[str, str]] = {
    "horseOrder": ("order", "pass"),
    "horseFinalPlace": ("place", "pass"),
    "prizeAmount": ("prize", "pass"),
    "prizeCurrency": ("race.currency.code", "falsy"),
    "jockeyFirstName": ("jockey.firstName", "falsy"),
    "jockeyLastName": ("jockey.lastName", "falsy"),
    "jockeyWeight": ("jockeyWeight", "pass"),
    "trackDistance": ("race.trackDistance", "pass"),
    "temperature": ("race.temperature", "pass"),
    "weather": ("race.weather", "pass"),
    "raceGroup": ("race.group", "pass"),
    "raceSubtype": ("race.subType", "pass"),
    "raceCategoryName": ("race.category.name", "pass"),
    "cityName": ("race.city.name", "pass"),
    "trackTypeName": ("race.trackType.name", "pass"),
}

CAREER_MAPPING: Mapping[str, tuple[str, str]] = {
    "raceYear": ("raceYear", "pass"),
    "raceName": ("", "const:"),
    "prize": ("prize", "string"),
    "otherDetails": ("", "const:"),
    "horseAge": ("horseAge", "pass"),
    "raceType": ("raceType", "pass"),
    "raceCount": ("raceCount", "pass"),
    "raceWonCount": ("raceWonCount", "pass"),
    "racePrizeCount": ("racePrizeCount", "pass"),
}

RACES_INGEST_MAPPING: Mapping[str, tuple[str, str]] = {
    **{f: (f, "pass") for f in RACES_MAPPING},
    "prizeAmount": ("prizeAmount", "string"),
    "trackDistance": ("trackDistance", "double"),
    "temperature": ("temperature", "double"),
}
# --- end fixed values --------------------------------------------------------


def _rule(x: Column, path: str, rule: str) -> Column:
    if rule.startswith("const:"):
        return F.lit(rule[len("const:"):])
    v = _path(x, path)
    if rule == "pass":
        return v
    if rule == "falsy":
        return falsy_to_null(v)
    if rule in ("string", "double", "int", "long"):
        return v.cast(rule)
    raise ValueError(rule)


def map_struct(x: Column, mapping: Mapping[str, tuple[str, str]]) -> Column:
    """Re-struct one element by ``mapping``."""
    return F.struct(*[_rule(x, p, r).alias(name) for name, (p, r) in mapping.items()])


def map_struct_array(arr: Column, mapping: Mapping[str, tuple[str, str]]) -> Column:
    """Re-struct every element by ``mapping``; a NULL array becomes ``[]``."""
    out = F.transform(arr, lambda x: map_struct(x, mapping))
    return F.coalesce(out, F.array())


def flatten_races(arr: Column) -> Column:
    """Raw race results to the 15-field race element; non-array -> []."""
    return map_struct_array(arr, RACES_MAPPING)


def map_career(arr: Column) -> Column:
    """Career element for the target table (two constant '' fields, prize as text)."""
    return map_struct_array(arr, CAREER_MAPPING)


def map_races(arr: Column) -> Column:
    """Race element for the target table; distance and temperature to
    double under ANSI casting, so an uncastable value fails the job."""
    return map_struct_array(arr, RACES_INGEST_MAPPING)


def race_element(raw: Column) -> Column:
    """P6 then P9 on a single raw race element (the tabular form of
    ``map_races(flatten_races(arr))``)."""
    return map_struct(map_struct(raw, RACES_MAPPING), RACES_INGEST_MAPPING)


def flatten_profile(raw: DataFrame, career: str | None = "career_raw", races: str | None = "races_raw") -> DataFrame:
    """One raw profile row (nested API shape) to the flat record."""
    c = F.col
    cols = [
        c("id"), c("name"), c("sex").alias("gender"),
        falsy_to_null(c("color.polishName")).alias("color"),
        falsy_to_null(c("mother.name")).alias("mother"),
        falsy_to_null(c("mother.id"), "number").alias("motherId"),
        falsy_to_null(c("father.name")).alias("father"),
        falsy_to_null(c("father.id"), "number").alias("fatherId"),
        falsy_to_null(c("trainer.lastName")).alias("trainer"),
        c("breed"),
        falsy_to_null(first_elem(c("breeders"))["name"]).alias("breeder"),
        falsy_to_null(first_elem(c("raceOwners"))["name"]).alias("owner"),
        falsy_to_null(c("dateOfBirth")).alias("dateOfBirth"),
    ]
    if career:
        cols.append(fold_prizes(c(career)).alias("career"))
    if races:
        cols.append(flatten_races(c(races)).alias("races"))
    return raw.select(*cols)


def assemble_profiles(profile: DataFrame, career: DataFrame, races: DataFrame,
                      key: str = "id", status: str = "status") -> DataFrame:
    """An id survives only when all three landed responses are OK.

    Each side has one row per id, so the two inner joins are 1:1; AQE turns
    them into broadcasts only if a side turns out small at runtime.
    """
    ok = lambda d: d.where(F.col(status) == STATUS_OK).drop(status)
    return ok(profile).join(ok(career), key, "inner").join(ok(races), key, "inner")


def unnest_elements(df: DataFrame, arr: str, keep: Sequence[str], prefix: str = "") -> DataFrame:
    """One row per element with its 0-based position; empty/NULL arrays keep
    one row with NULL position (outer)."""
    out = df.select(*keep, F.posexplode_outer(arr).alias("pos", "_e"))
    return out.select(*keep, "pos", *[F.col(f"_e.{f}").alias(prefix + f)
                                      for f in df.schema[arr].dataType.elementType.names])
