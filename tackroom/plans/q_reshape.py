"""Registered queries for reshaping, the career fold and profile assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.functions.fold import fold_prize_rows, fold_prizes
from tackroom.operators.reshape import (
    assemble_profiles, flatten_profile, flatten_races, map_career, map_races, race_element, unnest_elements,
)
from tackroom.plans.registry import query, table
from tackroom.operators.features import race_rows
from tackroom.operators.skew import DEFAULT_MAX_NESTED, rank_in_group, split_by_group_size
from tackroom.schemas import RACE_FIELDS


def raw_profiles(spark, sf_dir):
    """Customers nested like an API profile response; dims are TPC-H sized
    (25 nations, 5 regions), so the planner broadcasts them."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sex"),
        F.struct(F.col("n_name").alias("polishName")).alias("color"),
        F.struct(F.col("c_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).alias("mother"),
        F.struct(F.col("n_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")).alias("father"),
        F.struct(F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("r_name")).alias("lastName")).alias("trainer"),
        F.col("c_mktsegment").alias("breed"),
        F.when(F.col("c_custkey") % 5 == 0, F.array()).otherwise(
            F.array(F.struct(F.col("n_name").alias("name")))).alias("breeders"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(
            F.array(F.struct(F.col("c_name").alias("name")))).alias("raceOwners"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("19"), (F.col("c_custkey") % 90 + 10).cast("string"), F.lit("-01-01")))
         .otherwise(F.lit("")).alias("dateOfBirth"),
    )


@query("flatten_profile", "P4 P5", sql="""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS gender, nullif(n_name, '') AS color,
  nullif(n_name, '') AS mother, CAST(nullif(c_nationkey, 0) AS BIGINT) AS motherId,
  nullif(r_name, '') AS father, CAST(nullif(n_regionkey, 0) AS BIGINT) AS fatherId,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE nullif(r_name, '') END AS trainer,
  c_mktsegment AS breed,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE nullif(n_name, '') END AS breeder,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE nullif(c_name, '') END AS owner,
  CASE WHEN c_acctbal > 0 THEN '19' || CAST(c_custkey % 90 + 10 AS VARCHAR) || '-01-01' END AS dateOfBirth
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def flatten_profile_q(spark, sf_dir):
    return flatten_profile(raw_profiles(spark, sf_dir), career=None, races=None)


def raw_race(prefix=""):
    """A raw race-result element built from one lineitem row."""
    c = lambda n: F.col(prefix + n)
    return F.struct(
        c("l_linenumber").alias("order"),
        c("l_quantity").cast("int").alias("place"),
        c("l_partkey").alias("prize"),
        c("l_tax").alias("jockeyWeight"),
        F.struct(c("l_returnflag").alias("firstName"),
                 F.when(c("l_linestatus") == "O", F.lit("")).otherwise(c("l_linestatus")).alias("lastName")
                 ).alias("jockey"),
        F.struct(c("l_quantity").cast("string").alias("trackDistance"),
                 c("l_discount").cast("string").alias("temperature"),
                 c("l_linestatus").alias("weather"),
                 c("l_returnflag").alias("group"),
                 F.concat(c("l_returnflag"), c("l_linestatus")).alias("subType"),
                 F.struct(F.when(c("l_returnflag") == "N", F.lit("")).otherwise(F.lit("USD")).alias("code")).alias("currency"),
                 F.struct(F.concat(F.lit("cat-"), c("l_suppkey").cast("string")).alias("name")).alias("category"),
                 F.struct(F.concat(F.lit("city-"), (c("l_suppkey") % 10).cast("string")).alias("name")).alias("city"),
                 F.struct(F.lit("T").alias("name")).alias("trackType"),
                 ).alias("race"))


def order_race_rows(spark, sf_dir, max_nested=DEFAULT_MAX_NESTED):
    """One row per (order, line): ``pos`` and the line as a mapped race element
    (P6 then P9), plus one all-NULL row for an order without lines (J4 outer).

    Orders of up to ``max_nested`` lines are nested (array sorted by every
    element field), mapped with ``transform`` and unnested. A larger order is
    never collected: its lines are mapped row by row with the same rules and
    placed by an exact distributed rank under the same ordering.
    """
    li = table(spark, sf_dir, "lineitem", spread=True) \
        .select(F.col("l_orderkey").alias("o_orderkey"), raw_race().alias("r"))
    small, hot = split_by_group_size(li, ["o_orderkey"], max_nested)
    nested = small.groupBy("o_orderkey").agg(F.sort_array(F.collect_list("r")).alias("races_raw"))
    mapped = nested.select("o_orderkey", map_races(flatten_races(F.col("races_raw"))).alias("races"))
    rows = mapped.select("o_orderkey", F.posexplode("races").alias("pos", "e"))
    if hot is not None:
        rows = rows.unionByName(rank_in_group(hot, ["o_orderkey"], ["r"], name="pos").select(
            "o_orderkey", F.col("pos").cast("int").alias("pos"), race_element(F.col("r")).alias("e")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return o.join(rows, "o_orderkey", "left")


RACES_SQL = """
SELECT o_orderkey, o_orderstatus,
  CASE WHEN l_orderkey IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY
    l_linenumber, CAST(l_quantity AS INTEGER), l_partkey, l_tax, l_returnflag,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE l_linestatus END,
    CAST(l_quantity AS VARCHAR), CAST(l_discount AS VARCHAR), l_linestatus, l_suppkey) - 1 END::INTEGER AS pos,
  l_linenumber AS horseOrder, CAST(l_quantity AS INTEGER) AS horseFinalPlace,
  CAST(l_partkey AS VARCHAR) AS prizeAmount,
  CASE WHEN l_orderkey IS NULL OR l_returnflag = 'N' THEN NULL ELSE 'USD' END AS prizeCurrency,
  nullif(l_returnflag, '') AS jockeyFirstName,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END AS jockeyLastName,
  l_tax AS jockeyWeight, l_quantity AS trackDistance, l_discount AS temperature,
  l_linestatus AS weather, l_returnflag AS raceGroup, l_returnflag || l_linestatus AS raceSubtype,
  'cat-' || CAST(l_suppkey AS VARCHAR) AS raceCategoryName,
  'city-' || CAST(l_suppkey % 10 AS VARCHAR) AS cityName, CASE WHEN l_orderkey IS NULL THEN NULL ELSE 'T' END AS trackTypeName
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
"""


def flatten_races_rows(spark, sf_dir, max_nested=DEFAULT_MAX_NESTED):
    rows = order_race_rows(spark, sf_dir, max_nested)
    return rows.select("o_orderkey", "o_orderstatus", "pos", *[F.col(f"e.{f}").alias(f) for f in RACE_FIELDS])


@query("flatten_races", "P6 P9 J4 F7 F8", sql=RACES_SQL)
def flatten_races_q(spark, sf_dir):
    return flatten_races_rows(spark, sf_dir)


def yearly_career(spark, sf_dir):
    """Per customer: one raw career element per order year (at most one per
    calendar year, so the array size is bounded by the date range)."""
    o = table(spark, sf_dir, "orders")
    yr = F.year("o_orderdate")
    per_year = o.groupBy("o_custkey", yr.alias("y")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("won"),
        F.count_if(F.col("o_orderstatus") == "P").alias("placed"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    elem = F.struct(F.col("y").alias("raceYear"), F.col("cents").alias("prize"),
                    (F.col("y") - 1990).alias("horseAge"), F.lit("Y").alias("raceType"),
                    F.col("n").cast("int").alias("raceCount"), F.col("won").cast("int").alias("raceWonCount"),
                    F.col("placed").cast("int").alias("racePrizeCount"))
    careers = per_year.groupBy("o_custkey").agg(F.sort_array(F.collect_list(elem)).alias("career_raw"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(careers, c.c_custkey == careers.o_custkey, "left").select("c_custkey", "career_raw")


YEARLY_SQL = """
  SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n,
    count_if(o_orderstatus = 'F') AS won, count_if(o_orderstatus = 'P') AS placed,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY 1, 2
"""


@query("map_career", "P8 J4", sql=f"""
SELECT c_custkey,
  CASE WHEN y IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY c_custkey ORDER BY y) - 1 END::INTEGER AS pos,
  CAST(y AS INTEGER) AS raceYear, CASE WHEN y IS NULL THEN NULL ELSE '' END AS raceName,
  CAST(cents AS VARCHAR) AS prize, CASE WHEN y IS NULL THEN NULL ELSE '' END AS otherDetails,
  CAST(y - 1990 AS INTEGER) AS horseAge, CASE WHEN y IS NULL THEN NULL ELSE 'Y' END AS raceType,
  CAST(n AS INTEGER) AS raceCount, CAST(won AS INTEGER) AS raceWonCount, CAST(placed AS INTEGER) AS racePrizeCount
FROM customer LEFT JOIN ({YEARLY_SQL}) yy ON c_custkey = o_custkey
""")
def map_career_q(spark, sf_dir):
    df = yearly_career(spark, sf_dir).select("c_custkey", map_career(F.col("career_raw")).alias("career"))
    return unnest_elements(df, "career", ["c_custkey"])


@query("career_features", "X1 X2 X3", sql=f"""
SELECT c_custkey,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS total_races, CAST(coalesce(sum(won), 0) AS BIGINT) AS total_wins,
  CAST(coalesce(sum(placed), 0) AS BIGINT) AS total_prize_count,
  round(CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0 ELSE sum(won) / sum(n) END, 6) AS career_win_rate,
  CAST(coalesce(sum(cents), 0) AS DOUBLE) AS career_prize
FROM customer LEFT JOIN ({YEARLY_SQL}) yy ON c_custkey = o_custkey
GROUP BY c_custkey
""")
def career_features_q(spark, sf_dir):
    from tackroom.operators.features import career_totals
    df = yearly_career(spark, sf_dir).select("c_custkey", map_career(F.col("career_raw")).alias("career"))
    return career_totals(df, "career").select(
        "c_custkey", "total_races", "total_wins", "total_prize_count",
        F.round("career_win_rate", 6).alias("career_win_rate"), "career_prize")


def conversation_elements(spark, sf_dir):
    """Conversation turns as career elements: a ``user`` turn is an anchor
    (its turn is the year), every other turn carries its whole text as prize."""
    cv = table(spark, sf_dir, "conversations")
    return cv.select("conv_id", "turn",
                     F.when(F.col("role") == "user", F.col("turn").cast("int")).alias("raceYear"),
                     F.col("text").alias("prize"))


FOLD_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text,
    sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM conversations),
anchors AS (SELECT conv_id, seg, turn, text AS p0 FROM t WHERE role = 'user'),
tails AS (SELECT conv_id, seg, string_agg(text, ' + ' ORDER BY turn) AS tail
          FROM t WHERE role <> 'user' AND seg > 0 AND text IS NOT NULL AND text <> '' GROUP BY 1, 2)
SELECT a.conv_id, a.turn AS anchor_turn, CAST(a.turn AS INTEGER) AS raceYear,
  CASE WHEN tail IS NULL THEN p0 WHEN p0 IS NOT NULL AND p0 <> '' THEN p0 || ' + ' || tail ELSE tail END AS prize
FROM anchors a LEFT JOIN tails USING (conv_id, seg)
"""


def fold_conversations(spark, sf_dir, max_nested=DEFAULT_MAX_NESTED):
    """Nested form: each conversation as one career array folded row-locally
    with ``aggregate``. A conversation above ``max_nested`` turns is not
    collected; it goes through the tabular scan, which gives the same rows."""
    el = conversation_elements(spark, sf_dir)
    small, hot = split_by_group_size(el, ["conv_id"], max_nested)
    arr = small.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "raceYear", "prize"))).alias("career"))
    out = arr.select("conv_id", F.explode(fold_prizes(F.col("career"))).alias("e")) \
             .select("conv_id", F.col("e.turn").alias("anchor_turn"), "e.raceYear", "e.prize")
    if hot is None:
        return out
    big = fold_prize_rows(hot, ["conv_id"], "turn", "raceYear", "prize") \
        .select("conv_id", F.col("turn").alias("anchor_turn"), "raceYear", "prize")
    return out.unionByName(big)


@query("fold_career_nested", "P7 F4", sql=FOLD_SQL)
def fold_career_nested(spark, sf_dir):
    return fold_conversations(spark, sf_dir)


@query("fold_career_window", "P7 F4", sql=FOLD_SQL)
def fold_career_window(spark, sf_dir):
    """Tabular form: chunked segmented scan, no per-group collection of elements."""
    el = conversation_elements(spark, sf_dir)
    out = fold_prize_rows(el, ["conv_id"], "turn", "raceYear", "prize")
    return out.select("conv_id", F.col("turn").alias("anchor_turn"), "raceYear", "prize")


@query("assemble_profiles", "J1", sql="""
WITH prof AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal IS NULL OR c_acctbal >= 0),
car AS (SELECT o_custkey AS id, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY 1),
rac AS (SELECT o_custkey AS id, count(*) AS n_lines, round(sum(l_quantity), 2) AS sum_qty
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT id, name, n_orders, total_price, n_lines, sum_qty FROM prof JOIN car USING (id) JOIN rac USING (id)
""")
def assemble_profiles_q(spark, sf_dir):
    """Three landed per-id responses. Profile: every customer, answered 404
    when its account balance is negative; career and races: per-customer
    aggregates (partial aggregation, so a customer with a huge history costs
    no single task)."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    profile = c.select(F.col("c_custkey").alias("id"), "c_name",
                       F.when(F.col("c_acctbal") < 0, F.lit(404)).otherwise(F.lit(200)).alias("status"))
    career = o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.lit(200).alias("status"))
    races = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
              .groupBy(F.col("o_custkey").alias("id")).agg(
                  F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
                  F.lit(200).alias("status"))
    return assemble_profiles(profile, career, races).select(
        "id", F.col("c_name").alias("name"), "n_orders", "total_price", "n_lines", "sum_qty")


@query("race_context_rows", "X7 P6 P9", sql="""
SELECT o_orderkey, l_returnflag AS race_group, l_returnflag || l_linestatus AS race_subtype,
  'cat-' || CAST(l_suppkey AS VARCHAR) AS race_category, 'city-' || CAST(l_suppkey % 10 AS VARCHAR) AS city,
  CASE WHEN l_orderkey IS NULL THEN NULL ELSE 'T' END AS track_type, l_linestatus AS weather,
  l_discount AS temperature, l_quantity AS track_distance, l_tax AS jockey_weight,
  CAST(l_quantity AS INTEGER) AS final_place
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def race_context_rows(spark, sf_dir):
    """One feature row per (order, race) with the race context renamed."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                                 F.array(race_element(raw_race())).alias("races"))
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return o.join(race_rows(li, ["o_orderkey"]), "o_orderkey", "left")
