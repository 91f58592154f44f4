"""Waveform-feature multiclass workload (embeddings stand in for ECG features).

Label index -> assemble -> vector index (categorical dims <= 100 values) ->
70/30 split -> decision tree or multinomial logistic regression -> metrics.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.evaluate import classification_metrics, misclassified, scored_facts
from clinlake.operators.features import index_vector, vector_cardinality
from clinlake.operators.models import MULTINOMIAL_PARAMS, fit_pipeline, logistic, score, tree
from clinlake.operators.profile import table_size
from clinlake.operators.split import hash_split, split_label, union_slices
from clinlake.operators.vector_sets import category_flags, category_maps
from clinlake.plans.standins import table
from clinlake.session import kept

# The vector-indexer category limit and train/test weights of the
# waveform workload.
MAX_CATEGORIES = 100
SPLIT = (0.7, 0.3)
SEED = 42


def waveform_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, Labels, features vector)`` from the embeddings table."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.col("label").cast("string").alias("Labels"),
                      array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def waveform_predictions(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Test rows scored by ``model`` (fitted once per application)."""
    return kept(spark, (f"waveform-{model}", sf_dir), lambda: _waveform_predictions(spark, sf_dir, model))


def _waveform_predictions(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    data = waveform_table(spark, sf_dir)
    # Both indexers are fitted on the whole table, as in the original flow, so
    # no test row can hold an unseen label or category.
    label_indexer = StringIndexer(inputCol="Labels", outputCol="indexedLabel").fit(data)
    vec_indexer, max_bins = index_vector(data, "features", "indexedFeatures", MAX_CATEGORIES)
    parts = split_label(data, "vec_id", SPLIT, seed=SEED)
    train, test = parts.where(F.col("part") == "train"), parts.where(F.col("part") == "test")
    if model == "tree":
        est = tree(max_bins=max_bins, seed=SEED, labelCol="indexedLabel", featuresCol="indexedFeatures")
    else:
        est = logistic(labelCol="indexedLabel", featuresCol="indexedFeatures", **MULTINOMIAL_PARAMS)
    fitted = fit_pipeline([label_indexer, vec_indexer, est], train)
    return score(fitted, test, ["vec_id"], "indexedLabel", positive_index=None)


def q_vector_index_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_cardinality(table(spark, sf_dir, "embeddings"), "embedding", MAX_CATEGORIES).drop("n_distinct")


def q_vector_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact number of distinct values of every dimension."""
    return vector_cardinality(table(spark, sf_dir, "embeddings"), "embedding", MAX_CATEGORIES).select("dim", "n_distinct")


def mixed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whose even dimensions hold few values (tenths, cut off) and whose odd ones hold many."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v, i: F.when(i % 2 == 0, F.floor(v * 10).cast("double")).otherwise(v))
    return table(spark, sf_dir, "embeddings").select("vec_id", x.alias("x"))


def q_vector_category_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which dimensions are categories, from sets that stop at 101 values."""
    return category_flags(mixed_vectors(spark, sf_dir), "x", MAX_CATEGORIES)


def q_vector_category_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every value of the categorical dimensions."""
    return category_maps(mixed_vectors(spark, sf_dir), "x", MAX_CATEGORIES)


def q_split_70_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One key in thirty is NULL: the parts must still cover the table.
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 30 != 0, F.col("vec_id")).alias("key"))
    train, test = hash_split(emb, "key", SPLIT, seed=SEED)
    return union_slices(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


def q_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_facts(waveform_predictions(spark, sf_dir, "tree"), ["vec_id"])


def q_multinomial_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_facts(waveform_predictions(spark, sf_dir, "multinomial"), ["vec_id"])


def q_waveform_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, precision, recall and accuracy of the multinomial model on the test part."""
    return classification_metrics(waveform_predictions(spark, sf_dir, "multinomial"), "label", "prediction")


def q_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision tree's accuracy (with precision, recall and F1) on the test part."""
    return classification_metrics(waveform_predictions(spark, sf_dir, "tree"), "label", "prediction")


def q_scored_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the scored test part."""
    return table_size(waveform_predictions(spark, sf_dir, "tree"))


def q_tree_misclassified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows the decision tree gets wrong: (prediction, label, probability), all of them."""
    preds = waveform_predictions(spark, sf_dir, "tree")
    return misclassified(preds, "label", "prediction", ["vec_id", "prediction", "label", "probability"])
