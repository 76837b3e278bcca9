"""Training and batch scoring with Spark ML (M4, M5).

The model is a ``Pipeline`` (indexers, one-hot encoding, imputation,
assembly, a multinomial classifier); training and scoring are distributed
(tree aggregation of gradients; scoring is a row-local transform).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS, POSITION_LABEL
from tackroom.operators.auc import one_vs_rest
from tackroom.session import scratch_dir


def build_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str = POSITION_LABEL,
                   model: str = "lr", max_iter: int = 50, seed: int = 7) -> Pipeline:
    stages = []
    cat_idx = [f"{c}__idx" for c in categorical]
    cat_vec = [f"{c}__vec" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=cat_idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=cat_idx, outputCols=cat_vec, handleInvalid="keep"))
    num_imp = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=num_imp, strategy="median"))
    stages.append(VectorAssembler(inputCols=cat_vec + num_imp, outputCol="features", handleInvalid="keep"))
    stages.append(StringIndexer(inputCol=label, outputCol="label_idx", handleInvalid="error"))
    if model == "lr":
        clf = LogisticRegression(featuresCol="features", labelCol="label_idx", family="multinomial",
                                 maxIter=max_iter)
    elif model == "rf":
        clf = RandomForestClassifier(featuresCol="features", labelCol="label_idx", seed=seed)
    else:
        raise ValueError(model)
    stages.append(clf)
    return Pipeline(stages=stages)


def prepare_numeric(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])


def _fit(pipeline: Pipeline, data: DataFrame) -> PipelineModel:
    *features, clf = pipeline.getStages()
    prepared = Pipeline(stages=features).fit(data)
    return _fit_classifier(prepared, clf, prepared.transform(data))


def _fit_classifier(features: PipelineModel, clf, data: DataFrame) -> PipelineModel:
    """The fitted feature stages and the classifier, fitted on the rows that they gave. The training summary of a two-class model
    holds the session, which cannot be sent to tasks once it has observed anything, so such a classifier is stored and read back
    without its summary."""
    model = clf.fit(data)
    if model.numClasses == 2 and model.hasSummary:
        path = scratch_dir(data.sparkSession, "model")
        model.write().save(path)
        model = type(model).load(path)
    return PipelineModel([*features.stages, model])


def _split(data: DataFrame, holdout: float, seed: int) -> list[DataFrame]:
    """The rows to fit on and those held out, written once: a random split sorts its input in every pass over it, and a training
    makes many."""
    spark, parts = data.sparkSession, []
    for part in data.randomSplit([1 - holdout, holdout], seed=seed):
        path = scratch_dir(spark, "split")
        part.write.parquet(path)
        parts.append(spark.read.parquet(path))
    return parts


def train(snapshot: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
          label: str = POSITION_LABEL, model: str = "lr", dry_run: bool = False,
          holdout: float = 0.2, seed: int = 7, **kw):
    """M5: fit on a snapshot; ``dry_run`` only describes what would be trained.

    ``model="auto"`` follows the ROC-AUC objective: logistic regression and a
    random forest are fitted on a seeded split, the one with the higher macro
    one-vs-rest AUC on the held-out rows wins and is refitted on all rows.
    """
    if dry_run:
        return (f"[DRY RUN] would train {model} on {len(categorical)} categorical and "
                f"{len(numeric)} numeric features, label {label}")
    data = prepare_numeric(snapshot, numeric)
    if model != "auto":
        return _fit(build_pipeline(categorical, numeric, label, model, **kw), data)
    fit_part, held = _split(data, holdout, seed)
    scores, prepared = {}, None
    for kind in ("lr", "rf"):
        opts = {k: v for k, v in kw.items() if kind == "lr" or k != "max_iter"}
        *features, clf = build_pipeline(categorical, numeric, label, kind, seed=seed, **opts).getStages()
        prepared = prepared or Pipeline(stages=features).fit(fit_part)  # the same stages on the same rows for both kinds
        m = _fit_classifier(prepared, clf, prepared.transform(fit_part))
        scores[kind] = macro_auc(score(held, m, numeric, keep=[label]), label)
    best = max(scores, key=lambda k: (scores[k] if scores[k] == scores[k] else -1.0))
    opts = {k: v for k, v in kw.items() if best == "lr" or k != "max_iter"}
    return _fit(build_pipeline(categorical, numeric, label, best, seed=seed, **opts), data)


def _label_order(model: PipelineModel) -> list[str]:
    for st in model.stages:
        if hasattr(st, "getInputCol") and st.hasParam("inputCol") and st.isSet("inputCol") \
                and st.getOutputCol() == "label_idx":
            return list(st.labels)
    raise ValueError("no label indexer in model")


def score(df: DataFrame, model: PipelineModel, numeric: Sequence[str],
          labels: Sequence[str] = CLASS_LABELS, keep: Sequence[str] = ()) -> DataFrame:
    """M4: ``scores`` aligned to ``labels``; a class the model never saw is 0.0.

    The label column is not needed for scoring; a placeholder is added so the
    fitted label indexer (which only passes rows through) does not fail.
    """
    order = _label_order(model)
    inp = prepare_numeric(df, numeric)
    if POSITION_LABEL not in inp.columns:
        inp = inp.withColumn(POSITION_LABEL, F.lit(order[0]))
    out = model.transform(inp)
    prob = vector_to_array(F.col("probability"))
    pos = {lbl: i for i, lbl in enumerate(order)}
    scores = F.array(*[F.element_at(prob, pos[l] + 1) if l in pos else F.lit(0.0) for l in labels])
    return out.select(*keep, scores.alias("scores"))


def macro_auc(scored: DataFrame, label: str = POSITION_LABEL, labels: Sequence[str] = CLASS_LABELS) -> float:
    """Mean exact one-vs-rest ROC AUC over the classes that are present (see ``operators.auc``)."""
    aucs = [r["auc"] for r in one_vs_rest(scored, label, "scores", labels).collect() if r["auc"] is not None]  # a row a class
    return sum(aucs) / len(aucs) if aucs else float("nan")
