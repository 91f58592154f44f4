"""Metric queries over rule-based predictions (so they can be checked in SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions import argmax_array
from clinlake.operators.evaluate import (auc_roc, binary_scorecard, classification_metrics,
                                         classification_report, confusion_matrix, misclassified, roc_curve)
from clinlake.plans.standins import rule_predictions, table

# Class names of the rule-based binary label.
CLASS_NAMES = ["routine", "priority"]


def _preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_predictions(table(spark, sf_dir, "orders"))


def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(_preds(spark, sf_dir), "label", "prediction")


def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = classification_metrics(_preds(spark, sf_dir), "label", "prediction")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = classification_report(_preds(spark, sf_dir), CLASS_NAMES, "label", "prediction")
    return r.select("row_name", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def q_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auc_roc(_preds(spark, sf_dir), "score", "label").select(F.round("auc", 6).alias("auc"))


def q_binary_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_scorecard(_preds(spark, sf_dir), "label", "prediction", "score")


def q_misclassified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return misclassified(_preds(spark, sf_dir), "label", "prediction",
                         ["o_orderkey", "prediction", "label", "probability"])


def q_argmax_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", argmax_array("embedding").alias("argmax"))


def q_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of the ROC curve, without those on straight lines."""
    preds = rule_predictions(table(spark, sf_dir, "orders")).withColumn("score", F.floor(F.col("score") / 100))
    return roc_curve(preds, "score", "label")
