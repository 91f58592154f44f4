"""Repeatable splits, slice unions and seeded shuffles."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions import hash_bucket, hash_order_key
from clinlake.operators.ranking import running_total

MODULUS = 10000


def _cuts(weights: Sequence[float]) -> list[int]:
    total = float(sum(weights))
    return [round(MODULUS * c / total) for c in accumulate(weights)]


def split_label(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), seed: int = 42,
                names: Sequence[str] = ("train", "test"), out: str = "part") -> DataFrame:
    """Tag each row with its split name from an md5 hash of ``'<seed>:<key>'``.

    Unlike ``randomSplit`` the assignment depends only on the key and seed, not
    on partitioning or row order, so re-runs (and task retries after an
    executor loss) always give the same parts.  It is a pure projection: no
    shuffle, no sampling pass.  A NULL key hashes as a fixed text, so its rows
    share one part.
    """
    if len(names) != len(weights):
        raise ValueError("one name per weight")
    b = hash_bucket(key, seed, MODULUS)
    expr = F.lit(names[-1])
    for cut, name in reversed(list(zip(_cuts(weights)[:-1], names[:-1]))):
        expr = F.when(b < cut, F.lit(name)).otherwise(expr)
    return df.withColumn(out, expr)


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Like ``randomSplit(weights)`` but keyed and repeatable: the parts of
    ``split_label`` as filters; they are disjoint and cover ``df``."""
    names = [str(i) for i in range(len(weights))]
    tagged = split_label(df, key, weights, seed, names, "__part")
    return [tagged.where(F.col("__part") == n).drop("__part") for n in names]


def union_slices(*dfs: DataFrame) -> DataFrame:
    """Stack frames with the same columns, matched by name (any column order)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def shuffle_rows(df: DataFrame, key: str, seed: int = 42, out: str = "shuffle_rank",
                 n_buckets: int | None = None) -> DataFrame:
    """Seeded random order as a 1-based rank column.

    Row order has no meaning in a DataFrame, so a shuffle is a rank by a
    seeded hash of the key (ties broken by the key).  Rows of equal keys are
    told apart by a hash of their other columns, and rows without a key are
    dealt by that hash alone, so neither crowds one bucket and every run gives
    the same ranks (rows equal in all columns are interchangeable).  The rank
    is computed with distributed running totals: no single-partition window.
    """
    other = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
    order = F.when(F.col(f"`{key}`").isNotNull(), hash_order_key(key, seed)).otherwise(F.pmod(other, F.lit(1 << 60)))
    keyed = df.withColumns({"__h": order, "__other": other, "__one": F.lit(1).cast("long")})
    ranked = running_total(keyed, ["__h", key, "__other"], ["__one"], n_buckets=n_buckets, prefix="__rank")
    return ranked.withColumnRenamed("__rank__one", out).drop("__h", "__other", "__one")
