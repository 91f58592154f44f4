"""K-fold model selection with out-of-fold predictions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions import hash_bucket
from clinlake.operators.evaluate import classification_metrics
from clinlake.operators.models import build_grid, default_parallelism, score
from clinlake.session import materialize


def with_folds(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Append the fold of every row, from the md5 hash of its key: the same in
    every run and partitioning.  Rows of one key share a fold (so do NULLs)."""
    if k < 2:
        raise ValueError("at least two folds")
    return df.withColumn(out, hash_bucket(key, seed, k))


def cross_validate(estimator, spec: Mapping[str, Sequence], df: DataFrame, keep: Sequence[str], label: str, features: str = "features",
                   fold: str = "fold", k: int = 5, metric: str = "weighted_f1", parallelism: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit every setting of ``spec`` once per fold on the rows of the other folds.

    Returns ``(settings, predictions)``: one row per setting with ``metric``
    over all out-of-fold predictions together, the best first (``setting``,
    ``params``, ``metric``); and the best setting's out-of-fold predictions:
    every row of ``df`` scored once, by a model that has not seen its fold.

    ``df`` is stored once, and all models are fitted on filters of that table.
    Each fit's predictions are stored as well, so a metric or a lost executor
    never fits a model again.  A fold without rows is left out; a fold that
    holds all rows cannot be learned from and raises.
    """
    estimator = estimator.copy()
    estimator.setLabelCol(label).setFeaturesCol(features)
    grid = build_grid(estimator, spec)
    rows = materialize(df.select(*dict.fromkeys([*keep, label, features, fold])), "fold-input")
    used = sorted(r[0] for r in rows.select(fold).distinct().limit(k + 1).collect())  # bounded: one row a fold
    if len(used) < 2:
        raise ValueError("the rows fill fewer than two folds")

    def predictions(job: tuple[int, int]) -> DataFrame:
        setting, part = job
        fitted = estimator.fit(rows.where(F.col(fold) != part), grid[setting])
        scored = score(fitted, rows.where(F.col(fold) == part), [*dict.fromkeys([*keep, fold])], label, positive_index=None)
        return materialize(scored, "fold-predictions")

    jobs = [(i, part) for i in range(len(grid)) for part in used]
    with ThreadPoolExecutor(parallelism or default_parallelism(rows, len(jobs))) as pool:
        found = dict(zip(jobs, pool.map(inheritable_thread_target(rows.sparkSession)(predictions), jobs)))
    whole = [reduce(DataFrame.unionByName, [found[i, part] for part in used]) for i in range(len(grid))]
    results = []
    for i, setting in enumerate(grid):
        value = classification_metrics(whole[i], "label", "prediction").first()[metric]  # bounded: one row
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda kv: kv[0].name))
        results.append((i, params, float(value)))
    results.sort(key=lambda r: (-r[2], r[0]))
    board = rows.sparkSession.createDataFrame(results, "setting int, params string, metric double")
    return board, whole[results[0][0]]
