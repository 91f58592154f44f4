"""Distinct values per vector dimension, as sets that stop growing.

Whether a dimension is a category (at most ``limit`` values) does not need all
its values: every task keeps at most ``limit`` + 1 of them per dimension and
drops the set when it overflows, so what is shuffled is bounded by tasks x
dimensions x ``limit``, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators.features import _array_col

# Cells merged into the sets at once.
CELLS = 1 << 20


class BoundedSets:
    """Per dimension the distinct values seen, or the fact that they are more than ``limit``.

    -0.0 counts as 0.0 and all NaN as one value, as in Spark's grouping.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.dim, self.bits = np.empty(0, np.int64), np.empty(0, np.int64)
        self.over = np.zeros(0, bool)

    def add(self, dim: np.ndarray, value: np.ndarray) -> None:
        if len(dim) and dim.max() >= len(self.over):
            self.over = np.append(self.over, np.zeros(int(dim.max()) + 1 - len(self.over), bool))
        open_ = ~self.over[dim]
        value = np.where(np.isnan(value), np.nan, value + 0.0)[open_]
        dim, bits = np.append(self.dim, dim[open_]), np.append(self.bits, value.view(np.int64))
        order = np.lexsort((bits, dim))
        dim, bits = dim[order], bits[order]
        new = np.append(True, (dim[1:] != dim[:-1]) | (bits[1:] != bits[:-1]))[:len(dim)]
        dim, bits = dim[new], bits[new]
        self.over |= np.bincount(dim, minlength=len(self.over)) > self.limit
        keep = ~self.over[dim]
        self.dim, self.bits = dim[keep], bits[keep]


def _sets(limit: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = BoundedSets(limit)
        for b in batches:
            lists = b.column("v")
            size = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
            cells = lists.flatten()
            begin = np.append(0, np.cumsum(size))
            dim = np.arange(begin[-1]) - np.repeat(begin[:-1], size)
            known = cells.is_valid().to_numpy(zero_copy_only=False)
            value = cells.to_numpy(zero_copy_only=False)
            for lo in range(0, len(dim), CELLS):
                some = slice(lo, lo + CELLS)
                # A dimension of NULLs alone is there too, with no value.
                sets.add(dim[some][known[some]], value[some][known[some]].astype(np.float64))
            if len(dim) and dim.max() >= len(sets.over):
                sets.over = np.append(sets.over, np.zeros(int(dim.max()) + 1 - len(sets.over), bool))
        every = np.arange(len(sets.over))
        yield pa.RecordBatch.from_arrays([pa.array(every.astype(np.int32)), pa.nulls(len(every), pa.float64()), pa.array(sets.over)], ["dim", "value", "over"])
        yield pa.RecordBatch.from_arrays([pa.array(sets.dim.astype(np.int32)), pa.array(sets.bits.view(np.float64), from_pandas=False),
                                          pa.nulls(len(sets.dim), pa.bool_())], ["dim", "value", "over"])

    return collect


def bounded_distinct(df: DataFrame, col: str, limit: int = 100) -> DataFrame:
    """``(dim, value, over)``: the tasks' sets merged.  One row of each
    dimension has no value and says whether any task's set overflowed."""
    found = df.select(_array_col(df, col).alias("v")).mapInArrow(_sets(limit), "dim int, value double, over boolean")
    return found.groupBy("dim", "value").agg(F.max("over").alias("over"))


def category_flags(df: DataFrame, col: str, max_categories: int = 100) -> DataFrame:
    """``(dim, n_values, is_categorical)`` as ``features.vector_cardinality``
    tells them (NULL counts of the others included), without counting every cell."""
    known = bounded_distinct(df, col, max_categories).groupBy("dim").agg(
        F.count("value").alias("n"), F.max(F.coalesce("over", F.lit(False))).alias("over"))
    few = ~F.col("over") & (F.col("n") <= max_categories)
    return known.select("dim", F.when(few, F.col("n")).alias("n_values"), few.alias("is_categorical"))


def category_maps(df: DataFrame, col: str, max_categories: int = 100) -> DataFrame:
    """``(dim, value, code)`` of the categorical dimensions, as a vector
    indexer codes them: 0.0 first where it occurs, then ascending (NaN last)."""
    sets = bounded_distinct(df, col, max_categories)
    flags = sets.groupBy("dim").agg(F.count("value").alias("n"), F.max(F.coalesce("over", F.lit(False))).alias("over"))
    few = flags.where(~F.col("over") & (F.col("n") <= max_categories)).select("dim")
    values = F.array_sort(F.collect_list(F.struct((F.col("value") != 0).alias("o"), "value")))  # at most ``max_categories``
    listed = sets.where("value is not null").join(few, "dim").groupBy("dim").agg(values.alias("v"))
    return listed.select("dim", F.posexplode("v").alias("code", "v")).select("dim", F.col("v.value").alias("value"), "code")
