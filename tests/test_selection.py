"""Exact quantiles, ROC curves, k-fold selection and boosting for several classes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clinlake.operators import boosting, ranking
from clinlake.operators.evaluate import auc_roc, classification_metrics, roc_curve
from clinlake.operators.folds import cross_validate, with_folds
from clinlake.operators.models import logistic, tree
from clinlake.operators.quantiles import exact_quantiles, quantile_bins, quantile_edges

from conftest import SF01


# ---- quantiles

def test_quantiles_are_the_smallest_values_that_reach_their_share(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 40, 997).astype(float), rng.normal(0, 1, 997)
    rows = [(float(x), float(y) if i % 10 else None, None, float("nan") if i % 3 else 2.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, `b c` double, none double, n double").repartition(5)
    shares = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    got = {(r.column, r.probability): r.value for r in exact_quantiles(df, df.columns, shares).collect()}
    columns = {"a": a, "b c": np.array([y for i, y in enumerate(b) if i % 10]), "n": np.full(333, 2.0)}
    assert set(got) == {(c, p) for c in columns for p in shares}
    for c, values in columns.items():
        ordered = np.sort(values)
        for p in shares:
            assert got[c, p] == ordered[max(1, len(ordered) - int(np.floor(len(ordered) - p * len(ordered)))) - 1]
    with pytest.raises(ValueError):
        exact_quantiles(df, ["a"], [1.5])


def test_bins_by_quantiles(spark):
    rows = [(float(i),) for i in range(100)] + [(0.0,)] * 100 + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "v double")
    edges = quantile_edges(df, ["v"], 4)
    assert edges == {"v": [0.0, 49.0]}  # half of the rows are zero: two edges fall together
    got = quantile_bins(df, ["v"], 4).groupBy("v_bin").count().collect()
    assert {r.v_bin: r["count"] for r in got} == {1: 149, 2: 51, None: 2}
    assert quantile_bins(df, ["v"], 1).where("v_bin = 0").count() == 200
    low = df.where("v < 10")
    assert quantile_bins(df, ["v"], 4, stats_from=low).agg(F.max("v_bin")).first()[0] == len(quantile_edges(low, ["v"], 4)["v"])


# ---- ROC curve

@pytest.mark.parametrize("bucket_rows", [250_000, 7])
def test_roc_points_and_area(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", bucket_rows)
    rng = np.random.default_rng(8)
    y = rng.random(600) < 0.4
    s = np.round(rng.normal(0, 1, 600) + y, 1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)] + [(None, 1.0), (0.5, None)], "score double, label double")
    full = [tuple(r) for r in roc_curve(df, "score", "label", drop_collinear=False).orderBy(F.desc("threshold")).collect()]
    want = [(float("inf"), 0.0, 0.0)] + [(t, (s[~y] >= t).mean(), (s[y] >= t).mean()) for t in sorted(set(s.tolist()), reverse=True)]
    assert np.allclose(np.array(full)[1:], np.array(want)[1:]) and full[0] == want[0]
    kept = np.array([tuple(r) for r in roc_curve(df, "score", "label").orderBy(F.desc("threshold")).collect()])
    # What is left out lies on the line between its neighbours.
    direction = np.diff(np.array(want)[:, 1:], axis=0)
    turns = np.abs(direction[:-1, 0] * direction[1:, 1] - direction[:-1, 1] * direction[1:, 0]) > 1e-12
    assert len(kept) == turns.sum() + 2 and len(kept) <= len(full)
    area = np.trapezoid(kept[:, 2], kept[:, 1])
    assert abs(area - auc_roc(df, "score", "label").first().auc) < 1e-12
    assert tuple(kept[-1, 1:]) == (1.0, 1.0)


def test_roc_of_one_class(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.7, 1.0)], "score double, label double")
    assert [r.fpr for r in roc_curve(df, "score", "label").where("threshold < 1").collect()] == [None]  # one point: the line is straight
    assert roc_curve(df.limit(0), "score", "label").count() == 1


# ---- k folds

def test_every_row_is_scored_once_by_a_model_that_has_not_seen_it(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 3))
    y = (x[:, 0] + 0.3 * rng.normal(0, 1, 400) > 0).astype(float)
    df = spark.createDataFrame([(i, float(t), r.tolist()) for i, (r, t) in enumerate(zip(x, y))], "id long, label double, v array<double>")
    df = with_folds(df.select("id", "label", array_to_vector("v").alias("features")), "id", 4)
    board, scored = cross_validate(logistic(), {"regParam": [0.01, 5.0], "maxIter": [10]}, df, ["id"], "label", k=4)
    rows = board.collect()
    assert [r.params for r in rows] == ["maxIter=10, regParam=0.01", "maxIter=10, regParam=5.0"] and rows[0].metric > 0.85
    got = scored.collect()
    assert sorted(r.id for r in got) == list(range(400))
    fold = {r.id: r.fold for r in df.collect()}
    for part in range(4):
        model = logistic(regParam=0.01, maxIter=10).setLabelCol("label").setFeaturesCol("features").fit(df.where(F.col("fold") != part))
        want = {r.id: r.prediction for r in model.transform(df.where(F.col("fold") == part)).collect()}
        assert {r.id: r.prediction for r in got if fold[r.id] == part} == want
    assert abs(rows[0].metric - classification_metrics(scored, "label", "prediction").first().weighted_f1) < 1e-12


def test_folds_repeat_and_need_rows(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 9 != 0, F.col("id")))
    a, b = (with_folds(d, "k", 5, 7).orderBy("id").collect() for d in (df, df.repartition(3)))
    assert a == b and len({r.fold for r in a if r.k is None}) == 1 and {r.fold for r in a} == set(range(5))
    with pytest.raises(ValueError):
        with_folds(df, "k", 1)
    one = df.select("id", F.lit(1.0).alias("label"), array_to_vector(F.array(F.lit(1.0))).alias("features"), F.lit(0).alias("fold"))
    with pytest.raises(ValueError):
        cross_validate(logistic(), {"maxIter": [1]}, one, ["id"], "label")


# ---- boosting

def _blobs(spark, n=500, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    centre = rng.normal(0, 2, (classes, 2, 4))
    x = centre[y, rng.integers(0, 2, n)] + rng.normal(0, 1, (n, 4))
    df = spark.createDataFrame([(i, float(t), r.tolist()) for i, (r, t) in enumerate(zip(x, y))], "id long, label double, v array<double>")
    return df.select("id", "label", array_to_vector("v").alias("features"))


def test_rounds_follow_the_softmax_residuals(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    df = _blobs(spark)
    model = boosting.fit_boosted(df, 3, "label", rounds=2, depth=3, rate=0.4)
    rows = df.orderBy("id").collect()
    y = np.array([r.label for r in rows]).astype(int)
    share = np.bincount(y) / len(y)
    scores = np.tile(np.log(share), (len(y), 1))
    for r in range(1, 3):
        p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
        for k in range(3):
            left = spark.createDataFrame([(x.id, x.features, float((t == k) - p[i, k])) for i, (x, t) in enumerate(zip(rows, y))], ["id", "features", "r"])
            tree = DecisionTreeRegressor(labelCol="r", maxDepth=3, seed=42 + r).fit(left)
            scores[:, k] += 0.4 * 3 * np.array([x.prediction for x in tree.transform(left).orderBy("id").collect()])
    got = np.array([x.scores for x in model.scores(df).orderBy("id").collect()])
    assert np.allclose(got, scores, atol=1e-9)
    out = model.transform(df)
    assert out.columns == [*df.columns, "probability", "prediction"]
    p = np.array([x.probability for x in out.orderBy("id").collect()])
    assert np.allclose(p, np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True), atol=1e-9)


def test_rounds_survive_a_restart(spark, tmp_path, monkeypatch):
    df, folder = _blobs(spark), str(tmp_path / "rounds")
    whole = boosting.fit_boosted(df, 3, "label", rounds=3, depth=2)
    boosting.fit_boosted(df, 3, "label", rounds=2, depth=2, folder=folder)
    (tmp_path / "rounds" / "scores-3").mkdir()  # a round that was broken off
    fits, plain = [], boosting.DecisionTreeRegressor.fit
    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", lambda self, *a: fits.append(1) or plain(self, *a))
    again = boosting.fit_boosted(df, 3, "label", rounds=3, depth=2, folder=folder)
    assert len(fits) == 3  # the third round alone
    a, b = ([r.probability for r in m.transform(df).orderBy("id").collect()] for m in (whole, again))
    assert np.allclose(a, b, atol=1e-12)
    with pytest.raises(ValueError, match="other settings"):
        boosting.fit_boosted(df, 3, "label", rounds=3, depth=5, folder=folder)


def test_labels_are_checked(spark):
    df = _blobs(spark, 40)
    for bad in (df.withColumn("label", F.lit(3.0)), df.withColumn("label", F.lit(None).cast("double")), df.limit(0)):
        with pytest.raises(ValueError):
            boosting.fit_boosted(bad, 3, "label", rounds=1)


def test_models_score_in_a_session_that_observes(spark):
    from clinlake.operators.models import forest, perceptron, score
    from clinlake.operators.profile import observe_size
    df, probe = observe_size(_blobs(spark, 60), "blobs")
    assert df.count() == 60 and probe.get["n_rows"] == 60
    for estimator in (logistic(maxIter=2), forest(numTrees=2), perceptron([4, 3], 3)):
        model = estimator.setLabelCol("label").setFeaturesCol("features").fit(df)
        assert score(model, df, ["id"], "label", None).count() == 60


def test_boosting_beats_the_tree(spark):
    """Ring-shaped classes, held-out rows.  (The waveform stand-in's labels are unrelated to its features: nothing is learned there.)"""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1200, 5))
    y = np.digitize((x ** 2).sum(axis=1), [2.5, 4.5, 7.0])
    df = spark.createDataFrame([(i, float(t), r.tolist()) for i, (r, t) in enumerate(zip(x, y))], "id long, label double, v array<double>")
    df = df.select("id", "label", array_to_vector("v").alias("features"))
    train, test = df.where("id < 800"), df.where("id >= 800")
    single = tree(labelCol="label", featuresCol="features").fit(train).transform(test)
    boosted = boosting.fit_boosted(train, 4, "label", rounds=8, depth=3, rate=0.25).transform(test)
    accuracy = [classification_metrics(p, "label", "prediction").first().accuracy for p in (single, boosted)]
    assert accuracy[1] >= accuracy[0] + 0.05


def test_forest_scorecard_against_spark(spark, monkeypatch):
    """All three figures of the forest's scorecard, with a small search in place of the 162 settings."""
    from clinlake.operators.evaluate import binary_scorecard
    from clinlake.operators.models import forest, score, tune
    from clinlake.plans.stroke import LABEL, stroke_train_test
    train, test = stroke_train_test(spark, SF01)
    model = tune(forest(seed=42), {"maxDepth": [3, 5], "numTrees": [5]}, train, LABEL, stabilize=False)
    scored = score(model, test, ["id"], LABEL)
    got = binary_scorecard(scored, "label", "prediction", "score").first()
    p = pd.DataFrame([(r.label, r.prediction, r.score) for r in scored.collect()], columns=["y", "p", "s"])
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert got.accuracy == round((p.y == p.p).mean(), 4) and abs(got.roc_auc - area) < 1e-4
    precision = sum((p.y == k).mean() * ((p.y == k) & (p.p == k)).sum() / max(1, (p.p == k).sum()) for k in (0.0, 1.0))
    assert abs(got.precision - precision) < 1e-4
