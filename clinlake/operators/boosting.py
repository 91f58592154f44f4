"""Gradient boosting for several classes.

Spark's own boosted trees tell two classes apart.  Here every round fits one
regression tree per class to what the softmax of the scores so far leaves
over, and adds it.  Scores stand in a table, one array per row, written anew
by every round, so a round reads one table and its cost does not grow with
the rounds before; finished rounds survive a restart.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.session import derived_path


@dataclass
class Boosted:
    """Trees by round and class, the step that each adds, and the first scores."""

    n_classes: int
    rate: float
    start: list[float]
    rounds: list[list[DecisionTreeRegressionModel]]

    def scores(self, df: DataFrame, features: str = "features", out: str = "scores") -> DataFrame:
        """Append the array of class scores: every tree's prediction once, added up in one array."""
        columns = df.columns
        totals = [F.lit(float(s)) for s in self.start]
        for r, trees in enumerate(self.rounds):
            df = _predicted(df, trees, features, f"__t{r}_")
            totals = [t + self.rate * F.col(f"__t{r}_{k}") for k, t in enumerate(totals)]
        return df.withColumn(out, F.array(*totals)).select(*columns, out)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Append ``probability`` (array) and ``prediction``; ties go to the lowest class."""
        scored = self.scores(df, features, "__scores").withColumn("probability", softmax("__scores"))
        best = (F.array_position("probability", F.array_max("probability")) - 1).cast("double")
        return scored.withColumn("prediction", best).drop("__scores")


def softmax(scores: str) -> F.Column:
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _predicted(df: DataFrame, trees: list, features: str, prefix: str) -> DataFrame:
    for k, tree in enumerate(trees):
        df = tree.copy().setFeaturesCol(features).setPredictionCol(f"{prefix}{k}").transform(df)
    return df


def _add(df: DataFrame, trees: list, rate: float, features: str, scores: str) -> DataFrame:
    """One round's trees added to stored scores."""
    new = F.array(*[F.col(scores)[k] + rate * F.col(f"__t{k}") for k in range(len(trees))])
    return _predicted(df, trees, features, "__t").withColumn(scores, new).select(*df.columns)


def fit_boosted(df: DataFrame, n_classes: int, label: str, features: str = "features", rounds: int = 10, depth: int = 4, rate: float = 0.5,
                seed: int = 42, folder: str | None = None) -> Boosted:
    """Boost ``rounds`` times on ``df`` (labels 0 to ``n_classes`` - 1).

    A round's target for class k is the label's indicator less the softmax
    probability of the scores so far.  A tree adds its leaves' mean targets
    times ``rate`` and the number of classes: Newton's step where all classes
    are equally likely, a shorter one elsewhere.  The trees of a round are
    fitted at the same time.

    ``folder`` names where the rounds are kept: given again, with the same
    settings and input, training goes on behind the last whole round there.
    A round counts as whole when its record is written, after its trees and
    scores.
    """
    spark = df.sparkSession
    folder = folder or derived_path(spark, "boosting")
    settings = {"n_classes": n_classes, "depth": depth, "rate": rate, "seed": seed}
    done = _rounds_in(spark, folder, settings)
    if done is None:
        rows = df.select(F.col(label).cast("int").alias("__label"), F.col(features).alias("__features"))
        bad = rows.where(F.col("__label").isNull() | (F.col("__label") < 0) | (F.col("__label") >= n_classes))
        counts = {r[0]: r[1] for r in rows.groupBy("__label").count().where(F.col("__label").between(0, n_classes - 1)).collect()}  # bounded: one row a class
        if not bad.isEmpty() or not counts:
            raise ValueError(f"labels are whole numbers from 0 to {n_classes - 1}, and there is at least one row")
        total = sum(counts.values())
        # The first scores are the classes' log shares; a class without rows starts far below.
        share = [counts.get(k, 0) / total or 1e-6 / total for k in range(n_classes)]
        start = [float(x) for x in spark.range(1).select(F.array(*[F.log(F.lit(s)) for s in share])).first()[0]]  # bounded: one row
        rows.withColumn("__scores", F.array(*[F.lit(s) for s in start])).write.parquet(f"{folder}/scores-0")
        _record(spark, folder, 0, {**settings, "start": start})
        done = (0, start)
    number, start = done
    trees = [[DecisionTreeRegressionModel.load(f"{folder}/tree-{r}-{k}") for k in range(n_classes)] for r in range(1, number + 1)]
    for r in range(number + 1, rounds + 1):
        scored = spark.read.parquet(f"{folder}/scores-{r - 1}")
        p = scored.withColumn("__p", softmax("__scores"))
        targets = {f"__r{k}": (F.col("__label") == k).cast("double") - F.col("__p")[k] for k in range(n_classes)}
        left = p.withColumns(targets).drop("__p").persist()

        def grow(k: int, r=r, left=left):
            fitted = DecisionTreeRegressor(featuresCol="__features", labelCol=f"__r{k}", maxDepth=depth, seed=seed + r).fit(left)
            fitted.write().overwrite().save(f"{folder}/tree-{r}-{k}")
            return fitted

        try:
            with ThreadPoolExecutor(min(n_classes, 8)) as pool:
                grown = list(pool.map(inheritable_thread_target(spark)(grow), range(n_classes)))
        finally:
            left.unpersist()
        _add(scored, grown, _step(rate, n_classes), "__features", "__scores").write.mode("overwrite").parquet(f"{folder}/scores-{r}")
        _record(spark, folder, r, {**settings, "start": start})
        trees.append(grown)
    return Boosted(n_classes, _step(rate, n_classes), list(start), trees[:rounds])


def _step(rate: float, n_classes: int) -> float:
    return rate * n_classes


def _file(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _record(spark: SparkSession, folder: str, number: int, settings: dict) -> None:
    spark.createDataFrame([(number, json.dumps(settings, sort_keys=True))], "round int, settings string").coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/round-{number}")


def _rounds_in(spark: SparkSession, folder: str, settings: dict) -> tuple[int, list[float]] | None:
    """The last whole round in a folder and the first scores; a folder of other settings is refused."""
    number, found = -1, None
    while True:
        system, path = _file(spark, f"{folder}/round-{number + 1}/_SUCCESS")
        if not system.exists(path):
            break
        number += 1
        found = json.loads(spark.read.parquet(f"{folder}/round-{number}").first()["settings"])  # bounded: one row
        if {k: found[k] for k in settings} != settings:
            raise ValueError(f"{folder} holds rounds of other settings: {found}")
    return (number, found["start"]) if found else None
