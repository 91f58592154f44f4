import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from clinlake.operators.evaluate import (auc_roc, class_stats, classification_metrics,
                                         classification_report, confusion_matrix, misclassified)
from clinlake.operators.features import index_categories, index_vector, vector_cardinality
from clinlake.operators.profile import profile_tables, table_size


def test_category_index_frequency_then_alpha(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    out = {r.v: r.v_label for r in index_categories(df, ["v"]).collect()}
    assert out == {"c": 0, "a": 1, "b": 2}


def test_vector_cardinality_agrees_with_vector_indexer(spark):
    rows = [(i, float(i % 50), float(i % 7), float(i) * 1.5) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(df)
    card = {r.dim: (r.n_values, r.is_categorical) for r in vector_cardinality(vec, "f", 100).collect()}
    assert card == {0: (50, True), 1: (7, True), 2: (None, False)}
    small = {r.dim: (r.n_values, r.is_categorical) for r in vector_cardinality(vec, "f", 20).collect()}
    assert small == {0: (None, False), 1: (7, True), 2: (None, False)}
    model, max_bins = index_vector(vec, "f", "fi", 100)
    assert set(model.categoryMaps) == {0, 1} and max_bins == 50


def test_vector_cardinality_counts_every_dimension(spark):
    rows = [([float(i % 50), float(i) * 1.5, None if i % 2 else float(i % 202), None],) for i in range(900)]
    card = {r.dim: (r.n_distinct, r.n_values, r.is_categorical)
            for r in vector_cardinality(spark.createDataFrame(rows, "f array<double>"), "f", 100).collect()}
    assert card == {0: (50, 50, True), 1: (900, None, False), 2: (101, None, False), 3: (0, 0, True)}


def _preds(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        y = float(rng.integers(0, 3))
        p = y if rng.random() < 0.6 else float(rng.integers(0, 3))
        rows.append((i, y, p))
    return spark.createDataFrame(rows, "id int, label double, prediction double")


def test_metrics_match_spark_evaluator(spark):
    df = _preds(spark)
    m = classification_metrics(df).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        assert abs(m[name] - ev.evaluate(df, {ev.metricName: metric})) < 1e-12
    assert abs(m.weighted_recall - m.accuracy) < 1e-12
    assert sum(r.n for r in confusion_matrix(df).collect()) == 600


def test_never_predicted_class_has_zero_precision(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], "label double, prediction double")
    stats = {r["class"]: r.precision for r in class_stats(df).collect()}
    assert stats[1.0] == 0.0 and stats[2.0] == 0.0
    rep = {r.row_name: r for r in classification_report(df, ["a", "b", "c"]).collect()}
    assert rep["accuracy"].f1 == 1 / 3 and rep["macro avg"].support == 3


def test_auc_exact_matches_unbinned_evaluator(spark):
    rng = np.random.default_rng(2)
    rows = [(float(np.round(rng.random(), 2)), float(rng.integers(0, 2))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s double, y double")
    got = auc_roc(df, "s", "y", n_buckets=6).first().auc
    from pyspark.ml.functions import array_to_vector
    vec = df.select(array_to_vector(F.array(1 - F.col("s"), F.col("s"))).alias("raw"), F.col("y"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="y", numBins=0)
    assert abs(got - ev.evaluate(vec)) < 1e-12
    neg = auc_roc(df.withColumn("s", -F.col("s")), "s", "y").first().auc
    assert abs(got + neg - 1) < 1e-12


def test_misclassified_rows(spark):
    df = _preds(spark)
    bad = misclassified(df, "label", "prediction", ["id"])
    assert bad.count() == df.where("label != prediction").count()
    assert misclassified(df, "label", "prediction", ["id"], n=5).count() == 5


def test_table_size_and_profile(spark):
    df = spark.createDataFrame([(1, "ab", [1.0, 2.0]), (2, None, None)], "k long, s string, a array<double>")
    r = table_size(df).first()
    assert (r.n_rows, r.n_bytes) == (2, 8 + 2 + 16 + 8)
    p = profile_tables({"t": df}).first()
    assert (p.table_name, p.n_rows, p.n_columns, p.n_bytes, p.n_nulls) == ("t", 2, 3, 34, 2)


def test_table_size_counts_ml_vectors_dense(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.sparse(5, [1], [2.0]),)], ["v"])
    r = table_size(df).first()
    assert (r.n_rows, r.n_bytes) == (2, (3 + 5) * 8)


def test_report_class_without_name_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "label double, prediction double")
    rows = {r.row_name for r in classification_report(df, ["a", "b"]).collect()}
    assert rows == {"a", "b", None, "accuracy", "macro avg", "weighted avg"}
