"""Record schemas of the keyed table. Field names are fixed values of the
data model; numeric widths marked "ours" are our choice (no DDL exists)."""

from pyspark.sql import types as T

# --- fixed values: element field names, in source order -------------------
CAREER_FIELDS = ["raceYear", "raceName", "prize", "otherDetails", "horseAge", "raceType",
                 "raceCount", "raceWonCount", "racePrizeCount"]
RACE_FIELDS = ["horseOrder", "horseFinalPlace", "prizeAmount", "prizeCurrency", "jockeyFirstName",
               "jockeyLastName", "jockeyWeight", "trackDistance", "temperature", "weather",
               "raceGroup", "raceSubtype", "raceCategoryName", "cityName", "trackTypeName"]
PROFILE_FIELDS = ["id", "name", "gender", "color", "mother", "motherId", "father", "fatherId",
                  "trainer", "breed", "breeder", "owner", "dateOfBirth", "career", "races"]
# --- end fixed values -------------------------------------------------------

CAREER_ELEM = T.StructType([
    T.StructField("raceYear", T.IntegerType()),          # ours
    T.StructField("raceName", T.StringType()),
    T.StructField("prize", T.StringType()),
    T.StructField("otherDetails", T.StringType()),
    T.StructField("horseAge", T.IntegerType()),          # ours
    T.StructField("raceType", T.StringType()),
    T.StructField("raceCount", T.IntegerType()),         # ours
    T.StructField("raceWonCount", T.IntegerType()),      # ours
    T.StructField("racePrizeCount", T.IntegerType()),    # ours
])

RACE_ELEM = T.StructType([
    T.StructField("horseOrder", T.IntegerType()),
    T.StructField("horseFinalPlace", T.IntegerType()),
    T.StructField("prizeAmount", T.StringType()),
    T.StructField("prizeCurrency", T.StringType()),
    T.StructField("jockeyFirstName", T.StringType()),
    T.StructField("jockeyLastName", T.StringType()),
    T.StructField("jockeyWeight", T.DoubleType()),
    T.StructField("trackDistance", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("weather", T.StringType()),
    T.StructField("raceGroup", T.StringType()),
    T.StructField("raceSubtype", T.StringType()),
    T.StructField("raceCategoryName", T.StringType()),
    T.StructField("cityName", T.StringType()),
    T.StructField("trackTypeName", T.StringType()),
])

# A flattened profile as it is landed (one NDJSON line per id).
STAGING_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("mother", T.StringType()),
    T.StructField("motherId", T.LongType()),
    T.StructField("father", T.StringType()),
    T.StructField("fatherId", T.LongType()),
    T.StructField("trainer", T.StringType()),
    T.StructField("breed", T.StringType()),
    T.StructField("breeder", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("dateOfBirth", T.StringType()),
    T.StructField("career", T.ArrayType(CAREER_ELEM)),
    # distances/temperatures arrive as text or number; the ingest cast decides
    T.StructField("races", T.ArrayType(T.StructType(
        [f if f.name not in ("trackDistance", "temperature") else T.StructField(f.name, T.StringType())
         for f in RACE_ELEM.fields]))),
])

TARGET_SCHEMA = T.StructType(
    [f for f in STAGING_SCHEMA.fields if f.name not in ("career", "races")]
    + [T.StructField("career", T.ArrayType(CAREER_ELEM)), T.StructField("races", T.ArrayType(RACE_ELEM)),
       T.StructField("updated_at", T.TimestampType())])

# Raw API response of one profile (only the paths that are read).
_NAME = T.StructType([T.StructField("name", T.StringType())])
RAW_PROFILE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("color", T.StructType([T.StructField("polishName", T.StringType())])),
    T.StructField("mother", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])),
    T.StructField("father", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])),
    T.StructField("trainer", T.StructType([T.StructField("lastName", T.StringType())])),
    T.StructField("breed", T.StringType()),
    T.StructField("breeders", T.ArrayType(_NAME)),
    T.StructField("raceOwners", T.ArrayType(_NAME)),
    T.StructField("dateOfBirth", T.StringType()),
])
