"""Registered queries for ML, the incremental mode and end-to-end flows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tackroom.operators.features import (
    birth_year, career_totals, jockey_weight_missing, position_class, race_context, trainer_stats,
)
from tackroom.operators.ml import score, train
from tackroom.operators.reshape import map_career
from tackroom.operators.scoring import class_probs, finishers, race_card
from tackroom.plans.flows import merge_clean_upsert
from tackroom.plans.q_io import MASTER_NAME, RUN_TS, STAMP_MILLIS
from tackroom.plans.q_reshape import yearly_career
from tackroom.plans.q_scoring import folded_values
from tackroom.plans.q_clean import CLEAN_REPORT_SQL
from tackroom.plans.registry import query, table
from tackroom.session import scratch_dir
from tackroom.sources.shards import read_shard_lines, write_batch_shards, write_line_shards
from tackroom.sources.tables import read_ranged, read_snapshot, read_target, write_snapshot
from tackroom.streaming.incremental import incremental_shards, incremental_upsert, shard_stream


@query("train_score", "M4 M5")
def train_score(spark, sf_dir):
    """Embeddings as feature rows: eight sums over all values, ``label`` mapped to
    the finish class. Train a multinomial model, score every row."""
    return _train_score(spark, sf_dir)


def _train_score(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    numeric = [f"f{i}" for i in range(8)]
    df = e.select("vec_id", *[v.alias(n) for v, n in zip(folded_values(), numeric, strict=True)], position_class(F.col("label")))
    model = train(df, [], numeric, model="auto")  # ROC-AUC objective picks lr or rf
    out = score(df, model, numeric, keep=["vec_id", "position_class"])
    probs = class_probs(F.col("scores"))
    return out.select("vec_id", "position_class", F.round(probs["1"], 6).alias("win_prob"),
                      F.round(F.array_max("scores"), 6).alias("top_prob"),
                      (F.abs(F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).alias("sums_to_one"),
                      F.size("scores").alias("n_scores"))


@query("train_score_checks", "M4 M5", sql="""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT vec_id) AS BIGINT) AS n_ids, TRUE AS sums_to_one,
  8 AS n_scores, TRUE AS in_range FROM embeddings
""")
def train_score_checks(spark, sf_dir):
    """What holds for any model: every row is scored once, with eight scores that sum to one."""
    p = _train_score(spark, sf_dir)
    return p.agg(F.count("*").alias("n_rows"), F.count_distinct("vec_id").alias("n_ids"), F.bool_and("sums_to_one").alias("sums_to_one"),
                 F.max("n_scores").alias("n_scores"),
                 F.bool_and(F.col("win_prob").between(0, 1) & (F.col("top_prob") >= F.col("win_prob"))).alias("in_range"))


@query("incremental_shards", "T1 S4", sql="""
SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total_value FROM events GROUP BY 1
""")
def incremental_shards_q(spark, sf_dir):
    """``events`` landed as shards of 1,000 ids, consumed by a streaming run
    (``availableNow``) that archives consumed files."""
    root = scratch_dir(spark, "stream-src")
    write_batch_shards(table(spark, sf_dir, "events").select("event_id", "event_type", "value"),
                       root, "event_id", 0, 1000, STAMP_MILLIS)
    sink, ckpt = scratch_dir(spark, "stream-sink"), scratch_dir(spark, "stream-ckpt")
    # availableNow with no file cap: everything new is one micro-batch per run
    lines = shard_stream(spark, root, layout="partitioned",
                         clean_source="archive", archive_dir=scratch_dir(spark, "stream-archive"))
    incremental_shards(lines, sink, ckpt)
    rec = spark.read.parquet(sink).select(F.from_json("line", "event_type string, value double").alias("r"))
    return rec.groupBy("r.event_type").agg(F.count(F.lit(1)).alias("n"),
                                           F.round(F.sum("r.value"), 2).alias("total_value"))


@query("incremental_upsert", "T2 J2 F13", sql="""
SELECT event_id AS id, user_id, upper(event_type) AS event_type FROM events
WHERE event_id <> 0  -- an id of 0 is falsy: the clean step drops it as id-less
""")
def incremental_upsert_q(spark, sf_dir):
    """Two landings of ``events``; the second repeats every id with the type
    upper-cased. Each run consumes only its own new shards and upserts them
    into a target partitioned by id range (1,000 ids, the landing batch), so
    a run reads and rewrites only the ranges its shards touch."""
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "user_id", "event_type")
    root = scratch_dir(spark, "upsert-src")
    target, ckpt = scratch_dir(spark, "upsert-target"), scratch_dir(spark, "upsert-ckpt")
    schema = "id long, user_id long, event_type string"
    write_batch_shards(ev, root, "id", 0, 1000, STAMP_MILLIS)
    # one micro-batch per run
    incremental_upsert(shard_stream(spark, root, layout="partitioned"),
                       target, ckpt, schema, "id", RUN_TS, range_width=1000)
    write_batch_shards(ev.withColumn("event_type", F.upper("event_type")), root, "id", 0, 1000,
                       STAMP_MILLIS + 1)
    incremental_upsert(shard_stream(spark, root, layout="partitioned"),
                       target, ckpt, schema, "id", "2024-06-02 00:00:00", range_width=1000)
    return read_ranged(spark, target).select("id", "user_id", "event_type")


def flow_lines(spark, sf_dir):
    """``events`` as JSON lines with defects by ``event_id % 20``: blank,
    trailing text, missing id, and a repeat of an earlier id."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    r = F.col("event_id") % 20
    body = F.concat(F.lit(',"user":'), F.col("user_id").cast("string"), F.lit(',"type":"'),
                    F.col("event_type"), F.lit('"}'))
    rec = lambda i: F.concat(F.lit('{"id":'), i.cast("string"), body)
    line = (F.when(r == 3, F.lit("  "))
            .when(r == 7, F.concat(rec(F.col("event_id")), F.lit(" trailing")))
            .when(r == 11, F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit("}")))
            .when(r == 13, rec(F.col("event_id") - 12))
            .otherwise(rec(F.col("event_id"))))
    return e.select("event_id", line.alias("line"))


@query("flow_merge_clean_upsert", "E1 E2", sql="""
SELECT id, "user", type FROM (
  SELECT CASE WHEN event_id % 20 = 13 THEN event_id - 12 ELSE event_id END AS id, user_id AS "user",
    event_type AS type, event_id,
    row_number() OVER (PARTITION BY CASE WHEN event_id % 20 = 13 THEN event_id - 12 ELSE event_id END
                       ORDER BY event_id) AS rn
  -- these three residues were rendered blank, malformed and id-less: the clean step drops exactly them
  FROM events WHERE event_id % 20 NOT IN (3, 7, 11))
WHERE rn = 1 AND id <> 0  -- an id of 0 is falsy: dropped as id-less
""")
def flow_merge_clean_upsert(spark, sf_dir):
    """Lines landed as shards, merged, cleaned, parsed and upserted into an
    empty target. (The WHERE in the oracle mirrors the defects, not a subset.)"""
    root = scratch_dir(spark, "flow-src")
    write_line_shards(flow_lines(spark, sf_dir), root, "event_id", 0, 1000, STAMP_MILLIS)
    target = scratch_dir(spark, "flow-target")
    b = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merge_clean_upsert(spark, root, target, "id long, user long, type string", "id", RUN_TS,
                       layout="partitioned", ledger=scratch_dir(spark, "flow-ledger"), buckets=b)
    return read_target(spark, target).select("id", "user", "type")


@query("flow_typed_ids", "E2 S8 S9", sql="""
SELECT event_id AS id, user_id AS "user", event_type AS type FROM events
WHERE event_id <> 0  -- rendered as the number 0, which is falsy: the clean step drops it as id-less
""")
def flow_typed_ids(spark, sf_dir):
    """``events`` as lines whose ids are whole numbers, decimals (``5.0``) or text, landed, merged, cleaned
    and upserted twice into one target: both runs find every id, and the second inserts none again."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    text = F.col("event_id").cast("string")
    shown = (F.when(F.col("event_id") % 3 == 1, F.concat(text, F.lit(".0")))
             .when(F.col("event_id") % 3 == 2, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text))
    line = F.concat(F.lit('{"id":'), shown, F.lit(',"user":"'), F.col("user_id").cast("string"), F.lit('","type":"'),
                    F.col("event_type"), F.lit('"}'))
    root, target = scratch_dir(spark, "typed-src"), scratch_dir(spark, "typed-target")
    write_line_shards(e.select("event_id", line.alias("line")), root, "event_id", 0, 10_000, STAMP_MILLIS)
    b = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for run_ts, buckets in ((RUN_TS, b), ("2024-06-02 00:00:00", b + 1)):  # the target keeps its own bucket count
        merge_clean_upsert(spark, root, target, "id long, user long, type string", "id", run_ts,
                           layout="partitioned", buckets=buckets)
    return read_target(spark, target).select("id", "user", "type")


CAREER = ["total_races", "total_wins", "total_prize_count", "career_win_rate", "career_prize"]
TRAINER = ["trainer_freq", "trainer_win_rate"]
CATEGORICAL = ["race_group", "race_subtype", "race_category", "city", "track_type", "weather", "jockey_weight_missing"]
NUMERIC = ["birth_year", *CAREER, *TRAINER, "temperature", "track_distance", "jockey_weight"]


def model_rows(spark, sf_dir):
    """The whole feature row (X1-X8) of every line of an order: the customer is the horse, its orders by year the career,
    the supplier the trainer, and columns of the order, customer and line are the race's context."""
    li = table(spark, sf_dir, "lineitem", spread=True)
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    career = career_totals(yearly_career(spark, sf_dir).select("c_custkey", map_career(F.col("career_raw")).alias("career")))
    horses = c.join(career.select("c_custkey", *CAREER), "c_custkey", "left")
    # a row a trainer, written once: read back, its size is known, so that lines need not move by trainer to meet a small table
    path = scratch_dir(spark, "trainers")
    trainer_stats(li, "l_suppkey", F.col("l_returnflag") == "R").withColumnRenamed("l_suppkey", "trainer").write.parquet(path)
    trainers = spark.read.parquet(path)
    # orders meet their horse before the lines meet their order: the last move of the lines is by order, as the ranking needs it
    races = o.join(horses, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = li.join(trainers, F.col("l_suppkey") == F.col("trainer"), "left").join(races, li.l_orderkey == o.o_orderkey)
    weight = F.nullif(F.col("l_tax"), F.lit(0.0))
    race = F.struct(
        F.col("o_orderpriority").alias("raceGroup"), F.col("l_linestatus").alias("raceSubtype"),
        F.col("o_orderstatus").alias("raceCategoryName"), F.col("c_nationkey").cast("string").alias("cityName"),
        F.col("c_mktsegment").alias("trackTypeName"), F.col("l_returnflag").alias("weather"),
        (F.col("l_discount") * 100).alias("temperature"), F.col("l_quantity").alias("trackDistance"),
        weight.alias("jockeyWeight"), F.col("l_linenumber").alias("horseFinalPlace"))
    # no career: no races; the trainer of a line has at least this line, unless it is NULL
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("horse_id"),
        birth_year(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("birth_year"),
        *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in CAREER), *TRAINER, race.alias("_race")) \
        .select("*", *race_context(F.col("_race"))).drop("_race") \
        .select("*", jockey_weight_missing(F.col("jockey_weight")).alias("jockey_weight_missing"),
                position_class(F.col("final_place"))).drop("final_place")


def _train_and_rank(spark, sf_dir):
    feats = model_rows(spark, sf_dir)
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "track_distance")
    feats = feats.withColumn("idx", F.row_number().over(w) - 1)
    root = scratch_dir(spark, "snapshot")
    write_snapshot(feats, root, "20240601")
    snap = read_snapshot(spark, root, "20240601")
    numeric = NUMERIC
    model = train(snap, CATEGORICAL, numeric)
    # scores feed two rankings: write them once to the shared folder (cuts the
    # lineage too, so a lost executor does not re-run the model)
    scored_path = scratch_dir(spark, "scored")
    score(snap, model, numeric, keep=["l_orderkey", "idx"]).write.parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    card = race_card(scored, "scores", "idx", ["l_orderkey"])
    top = finishers(scored, "scores", "idx", ["l_orderkey"])
    return card.join(top.select("l_orderkey", "idx", "position"), ["l_orderkey", "idx"], "left") \
               .select("l_orderkey", "idx", "number", F.round("win_prob", 6).alias("win_prob"), "rel_rank", "position")


@query("train_and_rank", "E3")
def train_and_rank(spark, sf_dir):
    """Whole feature rows (X1-X8) -> dated snapshot -> model -> per-order race card with the
    greedy predicted finish order (each order is a race of its lines)."""
    return _train_and_rank(spark, sf_dir)


@query("train_and_rank_checks", "E3", sql="""
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_rows, CAST(least(7, count(*)) AS BIGINT) AS n_picked, TRUE AS positions_ok,
  TRUE AS ranks_ok FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey
""")
def train_and_rank_checks(spark, sf_dir):
    """What holds for any model: per race, all rows on the card, min(7, n) different picks for the positions 1, 2, ...,
    and ranks from 1 to 100 with both ends taken (100 only, if all chances are equal)."""
    p = _train_and_rank(spark, sf_dir)
    picked = F.count("position")
    return p.groupBy("l_orderkey").agg(
        F.count("*").alias("n_rows"), picked.alias("n_picked"),
        ((F.count_distinct("position") == picked) & (F.max("position") == picked)).alias("positions_ok"),
        ((F.max("rel_rank") == 100) & (F.min("rel_rank").isin(1, 100))).alias("ranks_ok"))


@query("clean_job_files", "E1 S3 S7 F2 F5", sql=CLEAN_REPORT_SQL)
def clean_job_files(spark, sf_dir):
    """The clean job on files: the defect lines of ``clean_records`` landed as
    shards, merged into one physical master (S3), cleaned into a sibling
    ``_cleaned_deduped_<ts>`` output (S7); returns the report (A2)."""
    from tackroom.plans.flows import clean_job
    from tackroom.plans.q_clean import event_lines
    from tackroom.sources.shards import ORDER_COLS, cleaned_name, write_master

    root = scratch_dir(spark, "e1")
    write_line_shards(event_lines(spark, sf_dir), f"{root}/landing", "line_no", 0, 1000, STAMP_MILLIS)
    merged = read_shard_lines(spark, f"{root}/landing", layout="partitioned")
    master = f"{root}/{MASTER_NAME}"
    write_master(merged, master)
    lines = spark.read.text(master).select(
        F.lit(MASTER_NAME).alias("shard"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"), F.col("value").alias("line"))
    return clean_job(lines, cleaned_name(master, "2024-06-01T00:00:00.000Z"), ORDER_COLS)
