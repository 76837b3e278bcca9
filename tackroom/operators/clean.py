"""Line cleaning: blank / malformed / id-less classification, first-wins
de-duplication and the clean report (P1, P2, P3, A1, A2).

Plan shape: one projection parses each line once (the classification and the
key share the parse through subexpression elimination), then a single
``groupBy(status, key)`` with partial aggregation. A key that holds a third of
all lines, or the bucket of all malformed lines, is combined map-side to one
row per task before the shuffle, so no task receives a hot group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.constants import BEYOND_LIMITS, BLANK, DUPE, KEPT, MALFORMED, MISSING_ID
from tackroom.functions.jsonline import beyond_parser, id_identity, is_blank, js_truthy_id, record_id, strict_parse

CANDIDATE = "candidate"


def classify_lines(lines: DataFrame, order_cols: Sequence[str], line_col: str = "line",
                   id_field: str = "id", over_limits: str = "fail") -> DataFrame:
    """Add ``status`` (blank / malformed / missing_id / candidate) and ``key``.

    A line that fails to parse and lies beyond the parser's own limits (text of
    20 million characters, numbers of 1,000 digits, 1,000 opening brackets) may
    be valid: it fails the job, counts as malformed with
    ``over_limits='malformed'``, or gets a status of its own with ``'separate'``.

    ``key`` is the JS identity of the id (see ``id_identity``); it is NULL for
    anything but candidates.
    """
    line = F.col(line_col)
    # Parse once in its own projection; the classification below reads the
    # variant column several times, so Catalyst keeps the two apart instead
    # of inlining the parse into every branch.
    parsed = lines.select(*order_cols, line_col, strict_parse(line).alias("_rec"))
    rec = F.col("_rec")
    token = F.to_json(F.struct(*[F.col(c) for c in order_cols]))
    key = id_identity(record_id(rec, id_field), token)
    if over_limits not in ("fail", "malformed", "separate"):
        raise ValueError(over_limits)
    beyond = {"fail": F.raise_error(F.concat(F.lit("line beyond the JSON parser's limits: "), F.substring(line, 1, 80))).cast("string"),
              "malformed": F.lit(MALFORMED), "separate": F.lit(BEYOND_LIMITS)}[over_limits]
    malformed = F.when(beyond_parser(line), beyond).otherwise(F.lit(MALFORMED))
    status = (F.when(is_blank(line), F.lit(BLANK))
              .when(rec.isNull(), malformed)
              .when(~js_truthy_id(F.col("_key")), F.lit(MISSING_ID))
              .otherwise(F.lit(CANDIDATE)))
    keyed = parsed.select(*order_cols, line_col, "_rec", key.alias("_key"))
    return keyed.select(*order_cols, line_col, status.alias("status"),
                        F.when(status == CANDIDATE, F.col("_key")).alias("key"))


def group_lines(classified: DataFrame, order_cols: Sequence[str], line_col: str = "line",
                keep: str = "first") -> DataFrame:
    """One row per (status, key): line count ``n`` and the winning line.

    ``winner`` is the candidate line with the smallest (``keep='first'``) or
    largest (``keep='last'``) order key; it is NULL for the non-candidate
    buckets. Struct min/max compare field by field, order columns first.
    """
    payload = F.struct(*[F.col(c) for c in order_cols], F.col(line_col).alias("line"))
    pick = F.min if keep == "first" else F.max
    if keep not in ("first", "last"):
        raise ValueError(keep)
    return classified.groupBy("status", "key").agg(
        F.count(F.lit(1)).alias("n"),
        pick(F.when(F.col("status") == CANDIDATE, payload)).alias("winner"))


def kept_lines(grouped: DataFrame) -> DataFrame:
    """The de-duplicated records: winner fields plus the key parts.

    The filter is on an aggregate output, so Catalyst cannot push it below the
    aggregation and re-run the JSON parse for it.
    """
    return grouped.where(F.col("winner").isNotNull()) \
                  .select("winner.*", "key.kclass", "key.knum", "key.kstr")


def clean_report(grouped: DataFrame) -> DataFrame:
    """Counts of one clean run (A2). ``total`` includes blank lines; the
    classes always sum to it: total = kept + dupes + malformed + blank + missing_id."""
    st = F.col("status")
    n = F.col("n")
    zero = F.lit(0).cast("long")
    return grouped.agg(
        F.coalesce(F.sum(n), zero).alias("total"),
        F.count_if(st == CANDIDATE).cast("long").alias(KEPT),
        F.coalesce(F.sum(F.when(st == CANDIDATE, n - 1)), zero).alias(DUPE + "s"),
        F.coalesce(F.sum(F.when(st == MALFORMED, n)), zero).alias(MALFORMED),
        F.coalesce(F.sum(F.when(st == BLANK, n)), zero).alias(BLANK),
        F.coalesce(F.sum(F.when(st == MISSING_ID, n)), zero).alias(MISSING_ID),
    )


def dedupe_first(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                 keep: str = "first") -> DataFrame:
    """First (or last) row per key by ``order_cols`` for already-typed rows (A1).

    ``groupBy(key).agg(min(struct(order..., row...)))``: partial aggregation keeps
    hot keys cheap; the result has the input's columns.
    """
    others = [c for c in df.columns if c not in key_cols and c not in order_cols]
    payload = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in others])
    pick = F.min if keep == "first" else F.max
    return df.groupBy(*key_cols).agg(pick(payload).alias("_w")) \
             .select(*key_cols, *[F.col(f"_w.{c}").alias(c) for c in list(order_cols) + others]) \
             .select(*df.columns)


def clean(lines: DataFrame, order_cols: Sequence[str], line_col: str = "line",
          id_field: str = "id", keep: str = "first", over_limits: str = "fail") -> DataFrame:
    """Classification + grouping in one go; feed to ``kept_lines`` / ``clean_report``."""
    return group_lines(classify_lines(lines, order_cols, line_col, id_field, over_limits), order_cols, line_col, keep)
