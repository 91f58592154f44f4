import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

import __spark_entry__ as E
from clinlake.operators.evaluate import binary_scorecard, classification_metrics
from clinlake.operators.features import narrow
from clinlake.operators.models import (LR_GRID, RF_GRID, fit, forest, grid_size, leaderboard, logistic,
                                       perceptron, score, tune)


def _separable(spark, n=400):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        y = int(rng.integers(0, 2))
        rows.append((i, y, float(rng.normal(2 * y, 0.5)), float(rng.normal(-y, 0.5))))
    df = spark.createDataFrame(rows, "id int, y int, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_grid_sizes():
    assert grid_size(LR_GRID) == 16 and grid_size(RF_GRID) == 162


def test_tuned_logistic_beats_majority(spark):
    df = _separable(spark)
    model = tune(logistic(), {"regParam": [0.01, 0.1]}, df, "y", parallelism=2)
    preds = score(model, df, ["id"], "y")
    acc = preds.where("label = prediction").count() / preds.count()
    assert acc > 0.9
    sums = preds.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    assert leaderboard(spark, model).count() == 2


def test_forest_and_mlp_score_every_row(spark):
    df = _separable(spark, 200)
    rf = fit(forest(numTrees=5), df, "y")
    assert score(rf, df, ["id"], "y").count() == 200
    mlp = fit(perceptron([2, 4, 2], max_iter=20), df, "y")
    assert score(mlp, df, ["id"], "y").where("label = prediction").count() > 150


def test_scorecards_match_sparks_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    df = _separable(spark, 300)
    model = fit(logistic(maxIter=3, regParam=0.5), df, "y")
    raw = model.transform(df)
    card = binary_scorecard(score(model, df, ["id"], "y"), "label", "prediction", "score").first()
    metric = lambda m: MulticlassClassificationEvaluator(labelCol="y", metricName=m).evaluate(raw)
    auc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="probability", numBins=0).evaluate(raw)
    assert (card.accuracy, card.precision, card.roc_auc) == (round(metric("accuracy"), 4), round(metric("weightedPrecision"), 4), round(auc, 4))
    m = classification_metrics(score(model, df, ["id"], "y"), "label", "prediction").first()
    assert abs(m.weighted_f1 - metric("f1")) < 1e-9 and abs(m.weighted_recall - metric("weightedRecall")) < 1e-9


def test_metric_queries_match_sparks_evaluators(spark):
    """The metric rows that no SQL checks, against the evaluators on the same predictions."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from clinlake.plans import icu, image, stroke, waveform
    from conftest import SF001
    ask = lambda df, m: MulticlassClassificationEvaluator(labelCol="label", metricName=m).evaluate(df)
    for name, preds in (("tree_metrics", waveform.waveform_predictions(spark, SF001, "tree")),
                        ("waveform_metrics", waveform.waveform_predictions(spark, SF001, "multinomial"))):
        got = E.queries()[name](spark, SF001).first()
        assert abs(got.accuracy - ask(preds, "accuracy")) < 1e-9 and abs(got.weighted_f1 - ask(preds, "f1")) < 1e-9
    wrong = E.queries()["tree_misclassified"](spark, SF001)
    preds = waveform.waveform_predictions(spark, SF001, "tree")
    assert wrong.count() == preds.where("prediction <> label").count() and wrong.where("prediction = label").count() == 0
    for name, preds in (("stroke_scorecard", stroke._logistic(spark, SF001)[0]), ("icu_scorecard", icu.icu_predictions(spark, SF001))):
        got = E.queries()[name](spark, SF001).first()
        assert got.accuracy == round(ask(preds, "accuracy"), 4) and got.precision == round(ask(preds, "weightedPrecision"), 4)
    report = {r.row_name: r for r in E.queries()["mlp_report"](spark, SF001).collect()}
    assert abs(report["accuracy"].f1 - ask(image.mlp_predictions(spark, SF001), "accuracy")) < 1e-9


def test_forest_search_on_a_small_grid(spark):
    """The forest's path with two settings; the full grid of 162 runs as a registered query."""
    from clinlake.operators.evaluate import scored_facts
    df = _separable(spark, 200)
    model = tune(forest(seed=1), {"numTrees": [3, 5], "impurity": ["gini"]}, df, "y", parallelism=2)
    preds = score(model, df, ["id"], "y")
    assert binary_scorecard(preds, "label", "prediction", "score").first().accuracy > 0.9
    facts = scored_facts(preds, ["id"])
    assert facts.where("not prediction_is_argmax or not score_is_positive or probability_sum <> 1 or n_classes <> 2").count() == 0


def test_wide_inputs_are_narrowed(spark):
    df = _separable(spark, 200)
    assert narrow(df, "features", "y", 2, max_width=2) is None
    selector = narrow(df, "features", "y", 2, max_width=1)
    assert selector.selectedFeatures == [0]
