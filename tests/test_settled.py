"""Steps that are computed once: typed records, the records of a micro-batch, folder listings."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tackroom.functions.records import load_records
from tackroom.operators.ml import score, train
from tackroom.sources.landing import land, landed_files, read_landed
from tackroom.streaming.incremental import _records


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, texts):
    return spark.createDataFrame([("s", "f", 0, i, t) for i, t in enumerate(texts)],
                                 "shard string, file_path string, block_start long, row_id long, line string")


def test_a_line_is_parsed_once_however_many_fields_are_typed(spark):
    lines = _lines(spark, ['{"id":1,"a":"2.0","b":3}', '{"id":"2","a":null,"b":true}'])
    typed = load_records(lines, "id long, a long, b string")
    assert _plan(typed.select("id", "b")).count("parseJson") + _plan(typed.select("id", "b")).count("parse_json") == 1
    assert sorted(map(tuple, typed.collect())) == [(1, 2, "3"), (2, None, "true")]


def test_records_of_a_batch_are_typed_once(spark):
    """The first record of a key wins and rows without a key are all kept, without a second pass for these."""
    lines = _lines(spark, ['{"id":7,"k":1,"v":"a"}', '{"id":"7","k":1,"v":"b"}', '{"id":8,"v":"c"}', '{"id":9,"v":"c"}', '{"id":10,"k":2,"v":"d"}'])
    seen = []
    got = _records(lines, "k long, v string", lambda r: seen.append(r) or r, None, "k", "first")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a"), (None, "c"), (None, "c"), (2, "d")], key=str)
    assert "Union" not in _plan(seen[0])


def test_many_folders_are_listed_by_few_tasks(spark, tmp_dir):
    spark.range(300).select(F.col("id").alias("p"), "id").write.partitionBy("p").parquet(tmp_dir + "/t")
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "32")
    try:
        sc = spark.sparkContext
        sc.setJobGroup("listing", "listing")
        spark.read.schema("id long, p long").parquet(tmp_dir + "/t")
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("listing")]
        tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "4096")
    assert tasks and max(tasks) <= 200


def test_a_landing_of_many_shards_is_written_by_few_tasks(spark, tmp_dir):
    """Every shard has a file of its own, and a task writes several of them."""
    land(spark.range(2000).select("id", F.lit("x").alias("v")), tmp_dir, "id", 0, 10, 7, "a")
    files = landed_files(spark, tmp_dir).collect()
    assert len(files) == len({f.file for f in files}) == 200 and all(f.n_lines == 10 for f in files)
    assert len({f.file.rsplit("/", 1)[1].split(".")[0] for f in files}) <= 8
    got = read_landed(spark, tmp_dir).select("shard", F.from_json("line", "id long")["id"].alias("id")).collect()
    assert sorted(r.id for r in got) == list(range(2000))
    assert all(r.shard == f"horse_data_{r.id // 10 * 10}_to_{r.id // 10 * 10 + 9}_7.ndjson" for r in got)


def test_a_two_class_model_scores_after_the_session_observed(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    df = spark.createDataFrame([(float(i % 2), "12"[i % 2]) for i in range(40)], "x double, position_class string")
    got = score(df, train(df, [], ["x"]), ["x"], keep=["x"]).collect()
    assert all((r.scores[0] > 0.5) == (r.x == 0.0) for r in got)
