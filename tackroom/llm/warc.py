"""WARC archives of pages, written and read by Spark's text source (operator 10).

A record is one row of the text writer, whose separator is the blank line that
ends a record. Reading splits the files at every ``WARC/1.0`` line, inside
payloads too: each piece is only a candidate record. Running sums of lengths
give its offset, its header the offset of its successor. Consecutive candidates
that link form runs; between the ends of runs pointer jumping from the start of
the file finds what is reachable. Candidates inside payloads are not, and their
bytes go back to the record that holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize

MAGIC = "WARC/1.0\r\n"   # first line of a record (fixed value)
CRLF = "\r\n"
MIN_REVISIT = 100        # bytes from which equal payloads are written once
FILE_RECORDS = 100_000   # records of a file, at most

RECORD_SCHEMA = ("id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _line_safe(c: Column) -> Column:
    """A header value on one line: control characters percent-encoded, null empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    for ch, code in (("\r", "%0D"), ("\n", "%0A")):
        c = F.replace(c, F.lit(ch), F.lit(code))
    return c


def _uri(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = MIN_REVISIT) -> None:
    """Write one record per row under ``path`` (WARC files, one or more per task).

    Of rows with equal payloads of ``min_revisit`` bytes or more, those with the
    smallest id become response records, the others revisit records without a
    payload, which name the response and the digest. Null payloads are empty.
    Rows without an id are always responses. Repeated rows (same id and payload)
    are written alike, one record each. An empty table writes no record.
    """
    spark = pages.sparkSession
    page = pages.select(F.col(id_col).cast("long").alias("id"), _line_safe(F.col(url_col)).alias("url"),
                        F.coalesce(payload_col, F.lit("")).alias("payload"))
    page = page.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    equal = materialize(page.where((F.col("size") >= min_revisit) & F.col("id").isNotNull()).select("id", "digest"), "digests")
    first = equal.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    # only repeated payloads: Spark broadcasts them if their files are small
    repeated = materialize(equal.join(first, "digest").where("id <> first").select("id", "digest", "first").distinct(), "revisits")
    rows = page.join(repeated, ["id", "digest"], "left")
    revisit = F.col("first").isNotNull()
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(CRLF + "WARC-Record-ID: "), _uri(F.col("id")),
        F.lit(CRLF + "WARC-Date: 1970-01-01T00:00:00Z" + CRLF + "WARC-Target-URI: "), F.col("url"),
        F.lit(CRLF + "WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(CRLF + "WARC-Refers-To: "), _uri(F.col("first")))).otherwise(F.lit("")),
        F.lit(CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string"), F.lit(CRLF + CRLF))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    (rows.select(F.concat(header, body).alias("value")).write.mode("errorifexists")
     .option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between ``WARC/1.0`` lines, with the place of each in its file."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("bytes")))


def _header(name: str) -> Column:
    return F.regexp_extract("header", rf"(?im)^{name}: *([^\r\n]*)", 1)


def reachable(candidates: DataFrame) -> DataFrame:
    """The candidates (file, start, next, ...) on the chain of records from the start of each file.

    ``next`` is null if the candidate declares no length. ``candidates`` must
    hold ``size``, the length of the file. A chain ends at the end of the file,
    at a place where no candidate begins, or before a record that is cut off.
    """
    by_file = Window.partitionBy("file").orderBy("start")
    linked = candidates.where(F.col("next") <= F.col("size"))
    linked = linked.withColumn("ends", F.coalesce(F.lead("start").over(by_file) != F.col("next"), F.lit(True)))
    # run: numbered by the candidates before it whose successor is not the next one
    linked = materialize(linked.withColumn("run", F.coalesce(F.sum(F.col("ends").cast("int")).over(
        by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "warc-candidates")
    entry = linked.select("file", F.col("start").alias("at"), F.col("run").alias("to_run"))
    jump = (linked.where("ends").select("file", "run", F.col("next").alias("at"))
            .join(entry, ["file", "at"]).select("file", "run", "to_run", "at"))
    jump = materialize(jump, "warc-jumps")          # run -> the run (and offset) that its end leads to
    pointer = jump.select("file", "run", "to_run")
    reached = materialize(linked.where("start = 0").select("file", "run"), "warc-reached")
    seen = -1
    while (n := reached.count()) != seen:
        seen = n
        step = reached.join(pointer, ["file", "run"]).select("file", F.col("to_run").alias("run"))
        reached = materialize(reached.union(step).distinct(), "warc-reached")
        again = pointer.select("file", F.col("run").alias("to_run"), F.col("to_run").alias("further"))
        pointer = materialize(pointer.join(again, ["file", "to_run"]).select("file", "run", F.col("further").alias("to_run")),
                              "warc-pointers")
    # a run is entered at its first reachable member, and all after that follow
    enter = (jump.join(reached, ["file", "run"]).groupBy("file", F.col("to_run").alias("run")).agg(F.min("at").alias("enter"))
             .union(linked.where("start = 0").select("file", "run", F.lit(0).cast("long"))))
    enter = enter.groupBy("file", "run").agg(F.min("enter").alias("enter"))
    return linked.join(enter, ["file", "run"]).where("start >= enter").drop("run", "ends", "enter")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the WARC files under ``path``: RECORD_SCHEMA, and payload (binary) if asked for.

    Lines ``WARC/1.0`` inside payloads are not records; see ``reachable``. Bytes
    after the last complete record of a file are ignored. A revisit record gets
    size, digest and payload of the response that it names (null if that is not
    there). A folder without records gives none.
    """
    pieces = _pieces(spark, path)
    piece = pieces.withColumn("header", F.substring_index(F.decode("bytes", "iso-8859-1"), CRLF + CRLF, 1))
    length = F.expr("try_cast(nullif(regexp_extract(header, '(?im)^Content-Length: *([0-9]+)', 1), '') AS bigint)")
    piece = piece.select("file", "block", "row", F.octet_length("bytes").cast("long").alias("len"), length.alias("clen"),
                         (F.length("header") + 4).alias("hlen"), "header", "bytes")
    body = F.substring("bytes", F.col("hlen") + 1, F.col("clen").cast("int"))
    whole = F.col("clen") == F.col("len") - F.col("hlen") - 4
    kept = ["file", "block", "row", "len", "clen", "hlen", whole.alias("whole"),
            F.regexp_extract("header", r"(?i)WARC-Record-ID: *<urn:page:(-?[0-9]+)>", 1).alias("rid"),
            F.decode(F.encode(_header("WARC-Target-URI"), "iso-8859-1"), "utf-8").alias("url"),
            F.lower(_header("WARC-Type")).alias("record_type"),
            F.regexp_extract("header", r"(?i)WARC-Payload-Digest: *sha256:([0-9a-fA-F]+)", 1).alias("declared"),
            F.regexp_extract("header", r"(?i)WARC-Refers-To: *<urn:page:(-?[0-9]+)>", 1).alias("refers"),
            F.when(whole, F.sha2(body, 256)).alias("digest")]
    if payloads:
        kept.append(F.when(whole, body).alias("payload"))
    info = materialize(piece.select(*kept), "warc-pieces")
    # offsets: what stands before a piece is all earlier pieces and the magic between them
    order = Window.partitionBy("file").orderBy("block", "row")
    m = len(MAGIC)
    info = info.withColumn("n", F.row_number().over(order) - 1).withColumn(
        "begin", F.sum(F.col("len") + m).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("len") - m)
    size = F.max(F.col("begin") + F.col("len")).over(Window.partitionBy("file"))
    info = materialize(info.withColumn("size", size).withColumn("start", F.col("begin") - m)
                       .withColumn("next", F.col("begin") + F.col("hlen") + F.col("clen") + 4), "warc-offsets")
    record = materialize(reachable(info.where("n > 0")), "warc-records")

    # records that hold the magic: their pieces, read again and put together in order
    broken = record.where("not whole").select("file", "start", F.col("n").alias("first"), "next", "hlen", "clen")
    # written out, so that the reading join below plans with its size: mostly it is small, and no page is shuffled
    parts = materialize(info.select("file", "n", "begin", "block", "row").join(broken, "file")
                        .where((F.col("n") >= F.col("first")) & (F.col("begin") - m < F.col("next")))
                        .select("file", "block", "row", "start", "n", "hlen", "clen"), "warc-parts")
    joined = (pieces.join(parts, ["file", "block", "row"])
              .groupBy("file", "start", "hlen", "clen").agg(F.array_sort(F.collect_list(F.struct("n", F.hex("bytes").alias("x")))).alias("p"))
              .select("file", "start", F.substring(F.unhex(F.array_join(F.transform("p", lambda q: q["x"]), MAGIC.encode().hex())),
                                                   F.col("hlen") + 1, F.col("clen").cast("int")).alias("bytes")))
    mended = joined.select("file", "start", F.sha2("bytes", 256).alias("digest"), *([F.col("bytes").alias("payload")] if payloads else []))
    cols = ["rid", "url", "record_type", "declared", "refers", "clen"]
    value = ["digest"] + (["payload"] if payloads else [])
    record = (record.where("whole").select(*cols, *value)
              .union(record.where("not whole").drop(*value).join(mended, ["file", "start"]).select(*cols, *value)))
    number = lambda c: F.expr(f"try_cast(nullif({c}, '') AS bigint)")
    extra = ["payload"] if payloads else []
    response = record.where("record_type <> 'revisit'").select(
        number("rid").alias("id"), "url", F.col("clen").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"), *extra)
    target = response.select(F.col("id").alias("refers_to"), "payload_bytes", "payload_digest", *extra).dropDuplicates(
        ["refers_to", "payload_digest"])
    revisit = (record.where("record_type = 'revisit'")
               .select(number("rid").alias("id"), "url", "record_type", number("refers").alias("refers_to"),
                       F.col("declared").alias("payload_digest"))
               .join(target, ["refers_to", "payload_digest"], "left")
               .select("id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *extra))
    return response.union(revisit)
