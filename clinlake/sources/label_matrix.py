"""Headerless numeric matrices with the class label in field 0.

A row is ``label,f0,f1,...``.  Wide rows (e.g. 100,352 features) are kept as
one array column; never one column per feature.
"""

from __future__ import annotations

import re

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_label_matrix(spark: SparkSession, path: str, sep: str = ",", as_vector: bool = False,
                      label_col: str = "label", features_col: str = "features", place: bool = False) -> DataFrame:
    """Parse label-first rows into ``(label int, features array<double>)``.

    The whole line is split once; ``slice`` drops the label and ``transform``
    casts every remaining field, all inside the JVM.  ``sep`` is taken
    literally.  Blank lines are skipped.  ``place`` adds ``file``, ``split``
    and ``line``, which in this order sort the rows as they stand in the files
    (``operators.batches.number_rows`` numbers them); ``line`` ascends within a
    split and is no count.
    """
    text = spark.read.text(path)
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
             F.monotonically_increasing_id().alias("line")] if place else []
    text = text.select("value", *where)
    fields = F.split(F.trim(F.col("value")), re.escape(sep))
    parsed = (text.where(F.length(F.trim(F.col("value"))) > 0)
              .select(fields.alias("f"), *(["file", "split", "line"] if place else []))
              .select(*(["file", "split", "line"] if place else []), F.element_at("f", 1).cast("int").alias(label_col),
                      F.transform(F.slice("f", 2, F.size("f")), lambda x: x.cast("double"))
                      .alias(features_col)))
    if as_vector:
        parsed = parsed.withColumn(features_col, array_to_vector(features_col))
    return parsed


def write_label_matrix(df: DataFrame, label_col: str, array_col: str, path: str, sep: str = ",") -> str:
    """Write ``label,f0,f1,...`` text lines (no header) and return the path."""
    line = F.concat_ws(sep, F.col(label_col).cast("string"),
                       F.array_join(F.transform(array_col, lambda x: x.cast("string")), sep))
    df.select(line.alias("value")).write.mode("errorifexists").text(path)
    return path
