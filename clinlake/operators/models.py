"""Model training, tuning and scoring on Spark ML.

Training data is made *stable* before a fit: written once as parquet to the
shared folder and persisted (memory and disk) from those files.  Iterative
fits then never re-run the feature pipeline, and a cache block lost with an
executor is re-read from identical files, so seeded sampling inside the
estimators (the train/validation split of the tuner, forest bootstraps)
sees exactly the same partitions on recomputation.  The tuning search runs
candidate fits in parallel, and scoring appends the positive-class
probability as a plain column, so metrics never need the predictions on the
driver.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators import forests
from clinlake.session import materialize

# Hyper-parameter grids of the tuned workloads
# (logistic regression: 2 x 2 x 2 x 2 = 16 settings;
#  random forest: 3 x 3 x 3 x 2 x 3 = 162 settings).
LR_GRID = {
    "regParam": [0.01, 0.1],
    "maxIter": [5, 10],
    "tol": [1e-4, 1e-5],
    "elasticNetParam": [0.25, 0.75],
}
RF_GRID = {
    "maxDepth": [5, 10, 20],
    "maxBins": [20, 32, 50],
    "numTrees": [20, 40, 60],
    "impurity": ["gini", "entropy"],
    "minInstancesPerNode": [1, 5, 10],
}
# The multinomial model of the waveform workload.
MULTINOMIAL_PARAMS = {"maxIter": 5, "regParam": 0.03, "elasticNetParam": 0.5}


def grid_size(spec: Mapping[str, Sequence]) -> int:
    n = 1
    for values in spec.values():
        n *= len(values)
    return n


def build_grid(estimator, spec: Mapping[str, Sequence]) -> list:
    """``ParamGridBuilder`` over ``spec`` (param name -> candidate values)."""
    b = ParamGridBuilder()
    for name, values in spec.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


MAX_CONCURRENT_FITS = 16


def default_parallelism(train: DataFrame, n_settings: int) -> int:
    """Concurrent candidate fits: the cluster's default parallelism, capped by the
    grid size and by ``MAX_CONCURRENT_FITS`` (each fit is itself a distributed job
    driven from a driver thread)."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n_settings, cores, MAX_CONCURRENT_FITS))


# Driver's heap for a node of a growing forest: the node, its split and statistics, and its place in the model (an estimate).
NODE_BYTES = 400


def forest_bytes(n_rows: int, spec: Mapping[str, Sequence]) -> int:
    """About what the largest forest of a grid takes on the driver, where Spark grows the trees."""
    leaves = min(2 ** max(spec["maxDepth"]), -(-n_rows // max(1, min(spec.get("minInstancesPerNode", [1])))))
    return max(spec["numTrees"]) * 2 * max(1, leaves) * NODE_BYTES


def forest_parallelism(train: DataFrame, spec: Mapping[str, Sequence]) -> int:
    """Concurrent fits of a grid of forests: ``default_parallelism``, and no more
    than half of the driver's heap holds of the largest one."""
    heap = train.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return max(1, min(default_parallelism(train, grid_size(spec)), heap // 2 // forest_bytes(train.count(), spec)))


def tune(estimator, spec: Mapping[str, Sequence], train: DataFrame, label: str,
         features: str = "features", train_ratio: float = 0.8, parallelism: int | None = None,
         seed: int = 42, metric: str = "f1", stabilize: bool = True) -> TrainValidationSplitModel:
    """Single-split model selection: fit every setting on ``train_ratio`` of
    ``train``, score the rest with the (weighted F1 by default) multiclass
    metric, refit the best on all of ``train``.

    ``train`` is made stable while the search runs (every candidate re-reads
    it, and the tuner's seeded split must see the same rows after a
    recomputation); ``parallelism`` candidate fits run at once (default: see
    ``default_parallelism``).  ``stabilize=False`` is for input that is already
    a deterministic filter of a stored table.  The tuner caches its two parts
    itself, so nothing is persisted around it.  Forests of a table within
    ``forests.MOST_CELLS`` are grown by `forests.search`, on the same split.
    """
    estimator = estimator.copy()
    estimator.setLabelCol(label).setFeaturesCol(features)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    grid = build_grid(estimator, spec)
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid,
                               evaluator=evaluator, trainRatio=train_ratio,
                               parallelism=parallelism or default_parallelism(train, len(grid)),
                               seed=seed)
    if stabilize:
        train = materialize(train, "tune-input")
    found = forests.search(estimator, grid, train, F.rand(seed) >= train_ratio, metric) if isinstance(estimator, RandomForestClassifier) else None
    return tvs._copyValues(TrainValidationSplitModel(*found)) if found else tvs.fit(train)


def leaderboard(spark, model: TrainValidationSplitModel) -> DataFrame:
    """``(setting, params, metric)`` per grid point; ``params`` in name order.  The table has one row per
    setting (bounded by the grid, not by the data)."""
    rows = []
    for i, (pm, m) in enumerate(zip(model.getEstimatorParamMaps(), model.validationMetrics)):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((i, params, float(m)))
    schema = T.StructType([T.StructField("setting", T.IntegerType()), T.StructField("params", T.StringType()),
                           T.StructField("metric", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


class _Lean:
    """An estimator whose models leave their training summary behind.  The
    summary holds the session, and Spark cannot send a session that has
    observed metrics (``profile.observe_size``) to the scoring tasks."""

    def _fit(self, dataset):
        model = super()._fit(dataset)
        if model.hasSummary:
            model._java_obj.setSummary(dataset.sparkSession.sparkContext._jvm.scala.Option.empty())
        return model


class _Logistic(_Lean, LogisticRegression):
    pass


class _Forest(_Lean, RandomForestClassifier):
    pass


class _Perceptron(_Lean, MultilayerPerceptronClassifier):
    pass


def logistic(**params) -> LogisticRegression:
    return _Logistic(**params)


def forest(seed: int = 42, **params) -> RandomForestClassifier:
    return _Forest(seed=seed, **params)


def tree(max_bins: int = 32, seed: int = 42, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxBins=max_bins, seed=seed, **params)


def perceptron(layers: Sequence[int], max_iter: int = 100, seed: int = 42, **params) -> MultilayerPerceptronClassifier:
    """Feed-forward classifier (sigmoid hidden layers, softmax output, L-BFGS).

    The weights (and L-BFGS state) live on the driver.  For very wide inputs
    use ``operators.network``, or ask for ``features.narrow`` first.
    """
    return _Perceptron(layers=list(layers), maxIter=max_iter, seed=seed, **params)


def stable(train: DataFrame, name: str = "train-input") -> DataFrame:
    """Written-then-persisted copy of ``train`` (see module docstring)."""
    return materialize(train, name).persist(StorageLevel.MEMORY_AND_DISK)


def fit(estimator, train: DataFrame, label: str, features: str = "features"):
    """Fit one estimator on a stable copy of the training frame."""
    est = estimator.copy()
    est.setLabelCol(label).setFeaturesCol(features)
    cached = stable(train)
    try:
        return est.fit(cached)
    finally:
        cached.unpersist()


def fit_pipeline(stages: Sequence, train: DataFrame) -> PipelineModel:
    """Fit a pipeline of (fitted or unfitted) stages on a stable copy of ``train``."""
    cached = stable(train)
    try:
        return Pipeline(stages=list(stages)).fit(cached)
    finally:
        cached.unpersist()


def score(model, df: DataFrame, keep: Sequence[str], label: str, positive_index: int | None = 1) -> DataFrame:
    """Batch scoring: ``keep`` columns, the label (as double), ``prediction``,
    ``probability`` as an array and, for binary models, ``score`` = the
    probability of class ``positive_index``."""
    out = model.transform(df)
    cols = [*[F.col(c) for c in keep], F.col(label).cast("double").alias("label"), F.col("prediction")]
    if "probability" in out.columns:
        prob = vector_to_array("probability")
        cols.append(prob.alias("probability"))
        if positive_index is not None:
            cols.append(F.element_at(prob, positive_index + 1).alias("score"))
    return out.select(*cols)

