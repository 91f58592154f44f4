"""Quantile bins, k-fold selection and boosting."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.boosting import fit_boosted
from clinlake.operators.evaluate import classification_metrics, scored_facts
from clinlake.operators.folds import cross_validate, with_folds
from clinlake.operators.models import logistic
from clinlake.operators.quantiles import exact_quantiles, quantile_bins
from clinlake.operators.split import split_label
from clinlake.plans.standins import table
from clinlake.plans.stroke import LABEL, stroke_source, stroke_train_test
from clinlake.plans.waveform import SEED, SPLIT
from clinlake.session import kept

# Settings of the queries: bins, folds, and the boosted model.
SHARES = [i / 10 for i in range(11)]
BINNED = ["o_totalprice", "o_custkey"]
N_BINS = 8
FOLDS = 3
GRID = {"regParam": [0.01, 0.1], "maxIter": [5]}
ROUNDS = 6


def q_exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deciles of two columns."""
    return exact_quantiles(table(spark, sf_dir, "orders"), BINNED, SHARES)


def q_quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's bin by price and by customer, eight bins of equal size each."""
    return quantile_bins(table(spark, sf_dir, "orders"), BINNED, N_BINS).select("o_orderkey", *[c + "_bin" for c in BINNED])


def q_fold_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of every row; one key in fifty is NULL."""
    keyed = stroke_source(spark, sf_dir).select("id", F.when(F.col("id") % 50 != 0, F.col("id")).alias("key"))
    return with_folds(keyed, "key", FOLDS, SEED)


def _cross_validated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = []

    def run():
        if not found:
            train, test = stroke_train_test(spark, sf_dir)
            rows = with_folds(train.unionByName(test), "id", FOLDS, SEED)
            found.extend(cross_validate(logistic(), GRID, rows, ["id"], LABEL, k=FOLDS))
        return found

    return kept(spark, ("fold-board", sf_dir), lambda: run()[0]), kept(spark, ("fold-scores", sf_dir), lambda: run()[1])


def q_fold_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every setting tried, with its parameters, and whether its F1 is a share."""
    board = _cross_validated(spark, sf_dir)[0]
    return board.select("setting", "params", F.col("metric").between(0.0, 1.0).alias("metric_is_share"))


def q_out_of_fold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scored once, by the model of the other folds."""
    return scored_facts(_cross_validated(spark, sf_dir)[1], ["id", "fold"])


def boosted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of the waveform table scored by boosted trees (fitted once per application)."""
    def build():
        rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"),
                                                         array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        parts = kept(spark, ("boosting-input", sf_dir), lambda: split_label(rows, "vec_id", SPLIT, seed=SEED))
        train, test = parts.where(F.col("part") == "train"), parts.where(F.col("part") == "test")
        n_classes = int(parts.agg(F.max("label")).first()[0]) + 1  # bounded: one row
        model = fit_boosted(train, n_classes, "label", rounds=ROUNDS, seed=SEED)
        return model.transform(test).select("vec_id", "label", "prediction", "probability")

    return kept(spark, ("boosted-predictions", sf_dir), build)


def q_boosted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_facts(boosted_predictions(spark, sf_dir), ["vec_id"])


def q_boosted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of the boosted trees on the test part."""
    return classification_metrics(boosted_predictions(spark, sf_dir), "label", "prediction")
