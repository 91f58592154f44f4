"""Delimited-file scans (CSV with a header line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   sep: str = ",", header: bool = True, mode: str = "PERMISSIVE", **options) -> DataFrame:
    """Scan delimited files into a DataFrame.

    With ``schema`` the scan is typed and needs no extra pass; codes that are
    all digits stay text and keep their leading zeros.  The header's names
    must be the schema's, in order; a file that differs fails instead of
    filling columns by place.  ``mode`` is Spark's parse mode: a bad field is
    NULL by default, ``FAILFAST`` raises.  ``schema=None`` infers
    the types from the data, which costs one extra full pass over the files
    and turns digit-only codes into numbers.  Works for any Hadoop file-system
    URI (local, HDFS, object stores): the path is only an argument.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None and header:
        reader = reader.option("enforceSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Write ``df`` as delimited text (one file per partition) and return the path."""
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)
    return path
