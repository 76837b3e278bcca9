"""Training and scoring: scores follow the fixed label order; AUC is sane."""

from pyspark.sql import functions as F

from tackroom.constants import CLASS_LABELS
from tackroom.operators.ml import macro_auc, score, train


def test_train_score_label_order(spark):
    rows = [(float(i % 5), float(i % 3), "A" if i % 2 else "B", ["1", "2", "other"][i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, c string, position_class string")
    assert "DRY RUN" in train(df, ["c"], ["x", "y"], dry_run=True)
    model = train(df, ["c"], ["x", "y"], max_iter=20)
    out = score(df, model, ["x", "y"], keep=["position_class"])
    r = out.first()
    assert len(r.scores) == len(CLASS_LABELS)
    # classes never seen score 0.0; the three seen ones sum to 1
    assert all(r.scores[i] == 0.0 for i in (2, 3, 4, 5, 6))
    assert abs(r.scores[0] + r.scores[1] + r.scores[7] - 1.0) < 1e-9
    auc = macro_auc(out)
    assert 0.5 <= auc <= 1.0


def test_auto_picks_by_auc(spark):
    rows = [(float(i % 5), float((i * 7) % 3), ["1", "2", "other"][(i % 5) % 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, y double, position_class string")
    model = train(df, [], ["x", "y"], model="auto", max_iter=20)
    out = score(df, model, ["x", "y"], keep=["position_class"])
    assert macro_auc(out) > 0.9  # the label is a function of x: the winner separates it


def test_auto_splits_and_prepares_its_rows_once(spark, monkeypatch):
    """The classifiers read a stored split, and the feature stages are fitted once for both and once for the refit."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    import tackroom.operators.ml as ml
    plans, fits = [], []
    for cls in (ml.LogisticRegression, ml.RandomForestClassifier):
        monkeypatch.setattr(cls, "fit", lambda self, data, *a, _fit=cls.fit, **kw: (
            plans.append(data._jdf.queryExecution().optimizedPlan().toString()), _fit(self, data, *a, **kw))[1])
    monkeypatch.setattr(StringIndexer, "fit", lambda self, data, *a, _fit=StringIndexer.fit, **kw: (
        fits.append(self.uid), _fit(self, data, *a, **kw))[1])
    rows = [(float(i % 7), "x" if i % 3 else "y", str(1 + i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b string, position_class string")
    model = ml.train(df, ["b"], ["a"], model="auto", max_iter=5)
    assert len(plans) == 3 and not any("Sample" in p for p in plans)
    assert len(fits) == 4  # two indexers (features, label), for the split and for the refit
    assert ml.score(df, model, ["a"]).count() == 200 and isinstance(ml.build_pipeline(["b"], ["a"]), Pipeline)
