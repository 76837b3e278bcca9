"""Exact area under the ROC curve from ranks (M5).

The area is the share of (positive, negative) pairs in which the positive has the
higher score, ties counting one half. Rows are counted per distinct score, and the
negatives below each score come from a running total over range partitions, so
neither a class with most rows nor a score that many share goes to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS, POSITION_LABEL
from tackroom.operators.running import totals_before


def roc_auc(scored: DataFrame, group_cols: Sequence[str], score: str, positive: str) -> DataFrame:
    """(group columns, n_pos, n_neg, auc) with ``positive`` a boolean column; NULL or NaN scores and NULL labels are left out. A
    group without a positive or without a negative has a NULL area."""
    known = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(positive).isNotNull())
    counts = {"pos": F.when(F.col(positive), F.lit(1)).otherwise(F.lit(0)), "neg": F.when(F.col(positive), F.lit(0)).otherwise(F.lit(1))}
    at = totals_before(known, group_cols, score, counts)
    # twice the pairs won, in whole numbers: two for each negative below, one for each with the same score
    wins = F.col("pos").cast("decimal(38,0)") * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(20,0)")
    out = at.groupBy(*group_cols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(wins).alias("_wins"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return out.select(*group_cols, "n_pos", "n_neg", F.when(pairs > 0, F.col("_wins").cast("double") / (2 * pairs)).alias("auc"))


def one_vs_rest(scored: DataFrame, label: str = POSITION_LABEL, scores: str = "scores", labels: Sequence[str] = CLASS_LABELS) -> DataFrame:
    """(class, n_pos, n_neg, auc): each class against the others, by its own score."""
    each = scored.select(F.col(label).alias("_label"), F.posexplode(F.slice(scores, 1, len(labels))).alias("_at", "_score")) \
        .select(F.get(F.array(*[F.lit(x) for x in labels]), F.col("_at")).alias("class"), "_score", "_label")
    return roc_auc(each.withColumn("_is", F.col("class") == F.col("_label")), ["class"], "_score", "_is")
