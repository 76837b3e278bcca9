"""Registered queries for the clean step (E1 slice) on the driver tables.

``events`` rows are rendered to JSON lines with deterministic defects chosen
by ``event_id % 50`` (every row is kept in the input; the modulus only picks
which kind of line a row becomes). The same rendering is written in SQL for
the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tackroom.operators.clean import clean, clean_report, dedupe_first, kept_lines
from tackroom.functions.jsonline import strict_parse
from tackroom.plans.registry import query, table


def event_lines(spark, sf_dir):
    e = table(spark, sf_dir, "events", spread=True).select("event_id", "user_id", "event_type")
    r = F.col("event_id") % 50
    eid = F.col("event_id").cast("string")
    body = F.concat(F.lit(',"user":'), F.col("user_id").cast("string"),
                    F.lit(',"type":"'), F.col("event_type"), F.lit('"}'))

    def with_id(idtext):
        return F.concat(F.lit('{"id":'), idtext, body)

    line = (F.when(r == 7, F.lit(""))
            .when(r == 17, F.lit(" \t "))
            .when(r == 11, F.concat(F.lit('{"id":'), eid, F.lit(',"user":')))
            .when(r == 13, F.concat(with_id(eid), F.lit(" xyz")))
            .when(r == 3, F.concat(F.lit("{'id':"), eid, F.lit("}")))
            .when(r == 19, F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit("}")))
            .when(r == 23, with_id(F.lit("0")))
            .when(r == 37, with_id(F.lit("null")))
            .when(r == 5, F.concat(F.lit("["), eid, F.lit("]")))
            .when(r.isin(29, 31), with_id((F.col("event_id") - 20).cast("string")))
            .when(r == 41, with_id(F.col("user_id").cast("string")))
            .when(r == 43, with_id(F.concat(F.lit('"'), eid, F.lit('"'))))
            .when(r == 47, with_id(F.concat((F.col("event_id") - 2).cast("string"), F.lit(".0"))))
            .otherwise(with_id(eid)))
    return e.select(F.col("event_id").alias("line_no"), line.alias("line"))


EVENT_LINES_SQL = """
  SELECT event_id AS line_no,
    CASE
      WHEN event_id % 50 = 7 THEN ''
      WHEN event_id % 50 = 17 THEN ' ' || chr(9) || ' '
      WHEN event_id % 50 = 11 THEN '{"id":' || event_id || ',"user":'
      WHEN event_id % 50 = 13 THEN '{"id":' || event_id || ',"user":' || user_id || ',"type":"' || event_type || '"} xyz'
      WHEN event_id % 50 = 3 THEN '{''id'':' || event_id || '}'
      WHEN event_id % 50 = 19 THEN '{"user":' || user_id || '}'
      WHEN event_id % 50 = 23 THEN '{"id":0,"user":' || user_id || ',"type":"' || event_type || '"}'
      WHEN event_id % 50 = 37 THEN '{"id":null,"user":' || user_id || ',"type":"' || event_type || '"}'
      WHEN event_id % 50 = 5 THEN '[' || event_id || ']'
      WHEN event_id % 50 IN (29, 31) THEN '{"id":' || (event_id - 20) || ',"user":' || user_id || ',"type":"' || event_type || '"}'
      WHEN event_id % 50 = 41 THEN '{"id":' || user_id || ',"user":' || user_id || ',"type":"' || event_type || '"}'
      WHEN event_id % 50 = 43 THEN '{"id":"' || event_id || '","user":' || user_id || ',"type":"' || event_type || '"}'
      WHEN event_id % 50 = 47 THEN '{"id":' || (event_id - 2) || '.0,"user":' || user_id || ',"type":"' || event_type || '"}'
      ELSE '{"id":' || event_id || ',"user":' || user_id || ',"type":"' || event_type || '"}'
    END AS line
  FROM events
"""

# Classification of a JSON line in SQL: blank, malformed, id class and value.
CLASSIFIED_SQL = """
  SELECT line_no, line,
    NOT regexp_matches(line, '[^\\s]') AS is_blank,
    json_valid(line) AS is_valid,
    CASE WHEN json_valid(line) THEN json_type(line, '$.id') END AS t,
    CASE WHEN json_valid(line) THEN json_extract_string(line, '$.id') END AS s
  FROM ({src})
"""

KEYED_SQL = """
  SELECT line_no, line, is_blank, is_valid,
    CASE WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN 'num'
         WHEN t = 'VARCHAR' THEN 'str' WHEN t = 'BOOLEAN' THEN 'bool'
         WHEN t IN ('OBJECT', 'ARRAY') THEN 'ref' END AS kclass,
    CASE WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN CAST(s AS DOUBLE) END AS knum,
    CASE WHEN t IN ('VARCHAR', 'BOOLEAN') THEN s END AS kstr
  FROM ({classified})
"""

STATUS_SQL = """
  SELECT *,
    CASE WHEN is_blank THEN 'blank' WHEN NOT is_valid THEN 'malformed'
         WHEN kclass IS NULL
           OR (kclass = 'num' AND knum = 0) OR (kclass = 'str' AND kstr = '')
           OR (kclass = 'bool' AND kstr = 'false') THEN 'missing_id'
         ELSE 'candidate' END AS status
  FROM ({keyed})
"""


def _status_sql(src: str) -> str:
    return STATUS_SQL.format(keyed=KEYED_SQL.format(classified=CLASSIFIED_SQL.format(src=src)))


RANKED_EVENTS_SQL = f"""
  SELECT *, CASE WHEN status = 'candidate' THEN row_number() OVER (
      PARTITION BY status, kclass, knum, kstr ORDER BY line_no) END AS rn
  FROM ({_status_sql(EVENT_LINES_SQL)})
"""


@query("clean_records", "S2 P1 P2 P3 A1 S7 F1 F3", sql=f"""
SELECT line_no, line, kclass, knum, kstr FROM ({RANKED_EVENTS_SQL}) WHERE rn = 1
""")
def clean_records(spark, sf_dir):
    g = clean(event_lines(spark, sf_dir), ["line_no"])
    return kept_lines(g).select("line_no", "line", "kclass", "knum", "kstr")


CLEAN_REPORT_SQL = f"""
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(rn = 1) AS BIGINT) AS kept,
       CAST(count_if(rn > 1) AS BIGINT) AS dupes,
       CAST(count_if(status = 'malformed') AS BIGINT) AS malformed,
       CAST(count_if(status = 'blank') AS BIGINT) AS blank,
       CAST(count_if(status = 'missing_id') AS BIGINT) AS missing_id
FROM ({RANKED_EVENTS_SQL})
"""


@query("clean_report", "A2", sql=CLEAN_REPORT_SQL)
def clean_report_q(spark, sf_dir):
    return clean_report(clean(event_lines(spark, sf_dir), ["line_no"]))


def _props_text():
    r = F.col("event_id") % 7
    p = F.col("props")
    return (F.when(r == 0, F.concat(p, F.lit(" x")))
            .when(r == 3, F.concat(p, F.lit(",")))
            .when(r == 5, F.regexp_replace(p, '"', "'"))
            .when(r == 6, F.concat(F.lit("["), p, F.lit("]")))
            .when(r == 4, F.concat(p, F.lit("}")))
            .otherwise(p))


@query("strict_json_reject", "P2 F1", sql="""
SELECT event_id, json_valid(text) AS is_valid FROM (
  SELECT event_id,
    CASE event_id % 7 WHEN 0 THEN props || ' x' WHEN 3 THEN props || ','
      WHEN 5 THEN replace(props, '"', '''') WHEN 6 THEN '[' || props || ']'
      WHEN 4 THEN props || '}' ELSE props END AS text
  FROM events)
""")
def strict_json_reject(spark, sf_dir):
    e = table(spark, sf_dir, "events", spread=True).select("event_id", _props_text().alias("text"))
    return e.select("event_id", strict_parse(F.col("text")).isNotNull().alias("is_valid"))


@query("dedupe_first", "A1", sql="""
SELECT user_id, event_id, epoch_us(ts) AS ts_us, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
""")
def dedupe_first_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    first = dedupe_first(e, ["user_id"], ["ts", "event_id"])
    return first.select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_type", "value")


ORDER_LINES_SQL = """
  SELECT o_orderkey AS line_no,
    CASE o_orderkey % 3
      WHEN 0 THEN '{"id":' || o_custkey || ',"o":' || o_orderkey || '}'
      WHEN 1 THEN '{"id":"' || o_custkey || '","o":' || o_orderkey || '}'
      ELSE '{"id":' || o_custkey || '.0,"o":' || o_orderkey || '}' END AS line
  FROM orders
"""


def order_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders", spread=True).select("o_orderkey", "o_custkey")
    ck = F.col("o_custkey").cast("string")
    tail = F.concat(F.lit(',"o":'), F.col("o_orderkey").cast("string"), F.lit("}"))
    r = F.col("o_orderkey") % 3
    line = (F.when(r == 0, F.concat(F.lit('{"id":'), ck, tail))
            .when(r == 1, F.concat(F.lit('{"id":"'), ck, F.lit('"'), tail))
            .otherwise(F.concat(F.lit('{"id":'), ck, F.lit(".0"), tail)))
    return o.select(F.col("o_orderkey").alias("line_no"), line.alias("line"))


@query("dedupe_typed_key", "P3 A1", sql=f"""
SELECT kclass, knum, kstr, line_no AS first_line_no FROM (
  SELECT *, row_number() OVER (PARTITION BY kclass, knum, kstr ORDER BY line_no) AS rn
  FROM ({_status_sql(ORDER_LINES_SQL)}) WHERE status = 'candidate')
WHERE rn = 1
""")
def dedupe_typed_key(spark, sf_dir):
    g = clean(order_lines(spark, sf_dir), ["line_no"])
    return kept_lines(g).select("kclass", "knum", "kstr", F.col("line_no").alias("first_line_no"))
