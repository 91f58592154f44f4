"""Image-feature classifier workload.

Precomputed image features arrive as headerless label-first text files (for
training, validation and testing) and are scanned as one array column.  A
feed-forward classifier is trained on them in mini-batches with momentum, as
the original does it (``operators.network``); Spark's own multilayer
perceptron (another optimiser) is there beside it.  The report is the
per-class table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators import network
from clinlake.operators.batches import cyclic_batches, number_rows
from clinlake.operators.evaluate import classification_report, scored_facts
from clinlake.operators.models import perceptron, score
from clinlake.operators.split import split_label
from clinlake.session import kept, kept_path
from clinlake.sources import read_label_matrix, write_label_matrix
from clinlake.plans.standins import table

SEED = 42
# Hidden layer widths, and 25 passes over the training data (the
# original's 25 epochs; one L-BFGS iteration is one full pass).
HIDDEN = (256, 16)
MAX_ITER = 25
N_CLASSES = 10


def image_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The train/test label-first feature files, written from ``embeddings`` once per application."""
    emb = split_label(table(spark, sf_dir, "embeddings"), "vec_id", (0.8, 0.2), seed=SEED)
    return tuple(kept_path(spark, (f"image-{name}", sf_dir), lambda path, name=name: write_label_matrix(
        emb.where(F.col("part") == name), "label", "embedding", path)) for name in ("train", "test"))


def mlp_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the perceptron (fitted once per application)."""
    def build():
        train, test = (read_label_matrix(spark, path, as_vector=True) for path in image_files(spark, sf_dir))
        # The input width is a model parameter: read it from one parsed row.
        dim = int(read_label_matrix(spark, image_files(spark, sf_dir)[0]).select(F.size("features")).first()[0])  # bounded: one row
        # The files are a stored table already, so the fit scans them.
        estimator = perceptron([dim, *HIDDEN, N_CLASSES], MAX_ITER, SEED).setLabelCol("label").setFeaturesCol("features")
        return score(estimator.fit(train), test, [], "label", positive_index=None)

    return kept(spark, ("mlp-predictions", sf_dir), build)


def q_mlp_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class of the test file (its rows have no key): rows scored, and what holds of all of them."""
    facts = scored_facts(mlp_predictions(spark, sf_dir), [])
    return facts.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("n_classes").alias("n_classes"),
                                      F.max(F.abs(F.col("probability_sum") - 1)).alias("probability_gap"),
                                      F.bool_and("prediction_is_argmax").alias("prediction_is_argmax"))


def q_mlp_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"class_{i}" for i in range(N_CLASSES)]
    return classification_report(mlp_predictions(spark, sf_dir), names, "label", "prediction")


# ---- mini-batch descent with momentum

# Rows of a step, passes, learning rate, momentum and decay of the original training.
BATCH = 32
EPOCHS = 25
RATE, MOMENTUM, DECAY = 1e-3, 0.9, 1e-3 / 25
NETWORK_PARTS = {"train": 0.7, "val": 0.1, "test": 0.2}
BATCH_EPOCHS = 3


def network_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The training, validation and test files, written from ``embeddings`` once per application."""
    emb = split_label(table(spark, sf_dir, "embeddings"), "vec_id", list(NETWORK_PARTS.values()), SEED, list(NETWORK_PARTS))
    return {name: kept_path(spark, (f"network-{name}", sf_dir), lambda path, name=name: write_label_matrix(
        emb.where(F.col("part") == name), "label", "embedding", path)) for name in NETWORK_PARTS}


def numbered_file(spark: SparkSession, path: str) -> DataFrame:
    """``(row, label, features)`` of a label-first file, numbered as the rows stand in it."""
    rows = number_rows(read_label_matrix(spark, path, place=True), ["file", "split", "line"])
    return rows.select("row", "label", "features")


def network_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The training history and the scored test file (trained once per application)."""
    history = []

    def build():
        rows = {name: numbered_file(spark, path) for name, path in network_files(spark, sf_dir).items()}
        # The input width is a model parameter: read it from one parsed row.
        dim = rows["train"].select(F.size("features")).first()[0]  # bounded: one row
        plan = network.Plan(dim, N_CLASSES, HIDDEN, RATE, MOMENTUM, DECAY, BATCH, EPOCHS, SEED)
        blocks = {name: network.feature_blocks(part, plan) for name, part in rows.items()}
        net = network.fit(blocks["train"], rows["train"].count(), plan, blocks["val"])
        history.append(network.history_table(spark, net))
        return network.predict(blocks["test"], net)

    scored = kept(spark, ("network-predictions", sf_dir), build)
    return kept(spark, ("network-history", sf_dir), lambda: history[0]), scored


def q_cyclic_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows each step of three epochs takes; the file does not divide evenly."""
    rows = number_rows(table(spark, sf_dir, "embeddings").select("vec_id"), ["vec_id"])
    return cyclic_batches(rows, rows.count(), BATCH, BATCH_EPOCHS).select("epoch", "step", "place", "vec_id")


def q_network_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy of every epoch, of the batches and of the validation file."""
    return network_results(spark, sf_dir)[0]


def q_network_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class of the test file: rows scored, and what holds of all of them."""
    facts = scored_facts(network_results(spark, sf_dir)[1], [])
    return facts.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("n_classes").alias("n_classes"),
                                      F.max(F.round(F.abs(F.col("probability_sum") - 1), 9)).alias("probability_gap"),
                                      F.bool_and("prediction_is_argmax").alias("prediction_is_argmax"))


def q_network_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-class table of the test file."""
    names = [f"class_{i}" for i in range(N_CLASSES)]
    return classification_report(network_results(spark, sf_dir)[1], names, "label", "prediction")
