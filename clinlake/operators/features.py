"""Feature engineering: category indexing, vector assembly, vector indexing."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import (StringIndexer, StringIndexerModel, UnivariateFeatureSelector, VectorAssembler,
                                VectorIndexer)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fit_category_index(df: DataFrame, cols: Sequence[str], suffix: str = "_label") -> StringIndexerModel:
    """One multi-column ``StringIndexer`` fit: most frequent value -> 0, ties
    alphabetical; NULL or unseen values raise at transform time.

    All columns are counted in a single pass (instead of one job per column);
    the fitted model holds only the distinct labels of each column.
    """
    cols = list(cols)
    return StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                         stringOrderType="frequencyDesc", handleInvalid="error").fit(df)


def index_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_label",
                     keep_nominal: bool = False, model: StringIndexerModel | None = None,
                     stats_from: DataFrame | None = None) -> DataFrame:
    """Append ``<c><suffix>`` codes for each of ``cols``, fitted on
    ``stats_from`` when given (values unseen there raise at transform time).

    ``keep_nominal=False`` casts the codes to int, which (as in the original
    recipe) drops the nominal ML metadata so trees treat codes as continuous;
    ``True`` keeps double codes with their metadata.
    """
    cols = list(cols)
    model = model or fit_category_index(stats_from if stats_from is not None else df, cols, suffix)
    out = model.transform(df)
    if not keep_nominal:
        out = out.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in cols})
    return out


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Assemble numeric columns into one ML vector (NULL/NaN raise by default)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def as_array(df: DataFrame, vector_col: str, out: str | None = None) -> DataFrame:
    """Export an ML vector as ``array<double>`` (comparable, SQL friendly)."""
    return df.withColumn(out or vector_col, vector_to_array(vector_col))


def _array_col(df: DataFrame, col: str) -> F.Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(col)


def vector_cardinality(df: DataFrame, col: str, max_categories: int = 100) -> DataFrame:
    """Per dimension: ``n_distinct`` = its exact number of distinct values,
    ``is_categorical`` = at most ``max_categories`` of them (the
    ``VectorIndexer`` rule), and ``n_values`` = their number where it is
    categorical (NULL for the other dimensions).

    Values are de-duplicated per (dimension, value), within each task first,
    and then counted per dimension.
    """
    cells = df.select(F.posexplode(_array_col(df, col)).alias("dim", "value"))
    exact = cells.groupBy("dim", "value").agg(F.lit(1).alias("__one")).groupBy("dim").agg(F.count_if(F.col("value").isNotNull()).alias("n_distinct"))
    few = F.col("n_distinct") <= max_categories
    return exact.select("dim", F.when(few, F.col("n_distinct")).alias("n_values"), few.alias("is_categorical"), "n_distinct")


def narrow(train: DataFrame, features: str, label: str, width: int, max_width: int = 1024, out: str = "narrowed"):
    """A fitted selector of the ``max_width`` features that tell the labels apart
    best (one F-test per feature, distributed), or None where ``width`` is
    within the bound."""
    if width <= max_width:
        return None
    return (UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=out, selectionMode="numTopFeatures")
            .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(max_width).fit(train))


def index_vector(df: DataFrame, col: str, out: str = "indexedFeatures", max_categories: int = 100):
    """Fit a ``VectorIndexer`` and return ``(model, max_bins)``.

    ``max_bins`` is the smallest tree ``maxBins`` that can split every
    categorical dimension: ``max(32, largest category count)``.  (A dimension
    with 33..100 values would otherwise make tree training fail.)
    """
    model = VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories).fit(df)
    sizes = [len(m) for m in model.categoryMaps.values()]
    return model, max([32, *sizes])


def feature_columns(df: DataFrame, categorical: Sequence[str], exclude: Sequence[str]) -> tuple[list, list]:
    """Split column names into (categorical, numeric) lists, skipping ``exclude``."""
    cat = [c for c in df.columns if c in set(categorical)]
    num = [c for c in df.columns if c not in set(categorical) and c not in set(exclude)]
    return cat, num
