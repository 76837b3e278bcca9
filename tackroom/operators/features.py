"""Feature derivation (X1-X8). Formulas are inferred from the feature
columns' names and values; each is isolated so it can be swapped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tackroom.constants import POSITION_LABEL, POSITION_OTHER
from tackroom.functions.columns import prize_total


def career_totals(df: DataFrame, career: str = "career", as_of_year: Column | int | None = None,
                  year: str = "raceYear") -> DataFrame:
    """X1-X3, row-local over the career array (no shuffle).

    ``as_of_year`` (a literal or a per-row column, e.g. the year of the race
    being predicted) keeps only career years before it, so the history does
    not include the outcome it is used to predict.
    """
    arr = F.coalesce(F.col(career), F.array())  # no career: no races
    if as_of_year is not None:
        cut = as_of_year if isinstance(as_of_year, Column) else F.lit(as_of_year)
        arr = F.filter(arr, lambda e: e[year] < cut)

    def total(field: str) -> Column:
        return F.aggregate(arr, F.lit(0).cast("long"), lambda acc, e: acc + F.coalesce(e[field], F.lit(0)).cast("long"))

    out = df.withColumn("total_races", total("raceCount")) \
            .withColumn("total_wins", total("raceWonCount")) \
            .withColumn("total_prize_count", total("racePrizeCount"))
    rate = F.coalesce(F.try_divide(F.col("total_wins").cast("double"), F.col("total_races").cast("double")),
                      F.lit(0.0))
    prize = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + F.coalesce(prize_total(e["prize"]), F.lit(0.0)))
    return out.withColumn("career_win_rate", rate).withColumn("career_prize", prize)


def trainer_stats(rows: DataFrame, trainer: str, win: Column, when: Column | None = None,
                  as_of: Column | str | None = None) -> DataFrame:
    """Per trainer, how many rows (``trainer_freq``) and the share won
    (``trainer_win_rate``). Partial aggregation keeps a busy trainer cheap.
    With ``as_of`` only rows whose ``when`` is before it are counted."""
    if as_of is not None:
        if when is None:
            raise ValueError("as_of needs the event time column 'when'")
        cut = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
        rows = rows.where(when < cut)
    return rows.groupBy(trainer).agg(F.count(F.lit(1)).alias("trainer_freq"),
                                     F.avg(win.cast("double")).alias("trainer_win_rate"))


def birth_year(date_text: Column) -> Column:
    """Year of a ``yyyy-MM-dd`` text date; unparseable -> NULL."""
    return F.year(F.try_to_date(date_text))


def jockey_weight_missing(weight: Column) -> Column:
    """X6: '1' when the weight is NULL, else '0'."""
    return F.when(weight.isNull(), F.lit("1")).otherwise(F.lit("0"))


def position_class(place: Column) -> Column:
    """Final place 1..7 as text, anything else 'other'."""
    return F.when(place.between(1, 7), place.cast("int").cast("string")).otherwise(F.lit(POSITION_OTHER)) \
            .alias(POSITION_LABEL)


RACE_CONTEXT = {"raceGroup": "race_group", "raceSubtype": "race_subtype", "raceCategoryName": "race_category",
                "cityName": "city", "trackTypeName": "track_type", "weather": "weather",
                "temperature": "temperature", "trackDistance": "track_distance",
                "jockeyWeight": "jockey_weight", "horseFinalPlace": "final_place"}


def race_context(race: Column) -> list[Column]:
    """X7 columns of one race element, renamed to feature names."""
    return [race[k].alias(v) for k, v in RACE_CONTEXT.items()]


def race_rows(df: DataFrame, keep: list[str], races: str = "races") -> DataFrame:
    """One row per (record, race) with the race context columns renamed."""
    e = df.select(*keep, F.explode_outer(races).alias("_r"))
    return e.select(*keep, *race_context(F.col("_r")))
