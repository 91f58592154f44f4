"""Type inference that keeps codes.

Spark's own inference turns ``0001`` into 1 and leaves a column of numbers as
text because of one ``N/A``.  Here every column is profiled as text in one
pass (one small aggregate row, merged from all tasks): what its values could
be, whether any has leading zeros, and how many are markers of a missing
value.  Types follow from the profile.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings of a missing value, compared without case and outer blanks.
MARKERS = ("", "na", "n/a", "nan", "null", "none", "?", "-", "unknown")

_INT = r"^[+-]?(0|[1-9][0-9]{0,17})$"
_WIDE = r"^[+-]?[0-9]+$"
_ZEROS = r"^[+-]?0[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?$"
_BOOL = r"(?i)^(true|false)$"


def _marker(value: F.Column, markers: Sequence[str]) -> F.Column:
    return F.lower(F.trim(value)).isin([m.lower() for m in markers])


def column_profile(df: DataFrame, markers: Sequence[str] = MARKERS) -> DataFrame:
    """One row per text column of ``df``: how many values it has, how many of
    them are markers, and how many of the rest look like each type.

    ``(column, n, n_markers, n_int, n_wide, n_zeros, n_number, n_date, n_timestamp, n_boolean)``;
    ``n_wide`` counts whole numbers of any length, ``n_zeros`` those with a
    leading zero.  A single aggregation, merged from partial counts.
    """
    def counts(c: str) -> F.Column:
        v = F.col(f"`{c}`")
        value = F.when(v.isNotNull() & ~_marker(v, markers), F.trim(v))
        like = lambda pattern: F.count_if(value.rlike(pattern))
        return F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.count_if(v.isNotNull() & _marker(v, markers)).alias("n_markers"),
                        like(_INT).alias("n_int"), like(_WIDE).alias("n_wide"), like(_ZEROS).alias("n_zeros"), like(_NUMBER).alias("n_number"),
                        F.count_if(value.rlike(_DATE) & value.try_cast("date").isNotNull()).alias("n_date"),
                        F.count_if(value.rlike(_TIME) & value.try_cast("timestamp_ntz").isNotNull()).alias("n_timestamp"), like(_BOOL).alias("n_boolean"))

    return df.agg(F.array(*[counts(c) for c in df.columns]).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def inferred_types(profile: DataFrame, max_markers: float = 0.5) -> dict[str, str]:
    """The type of each profiled column, as a DDL name.

    A column with any leading zero is a code and stays text.  So does one
    whose markers are more than ``max_markers`` of its values, or all of them:
    they are no gaps between numbers then.
    """
    out = {}
    for p in profile.collect():  # bounded: one row a column
        real = p["n"] - p["n_markers"]
        if not real or p["n_markers"] > max_markers * p["n"] or p["n_zeros"]:
            out[p["column"]] = "string"
        elif p["n_int"] == real:
            out[p["column"]] = "bigint"
        elif p["n_wide"] == real:
            out[p["column"]] = "string"  # digits that no whole-number type holds
        else:
            of = {"n_number": "double", "n_date": "date", "n_timestamp": "timestamp_ntz", "n_boolean": "boolean"}
            out[p["column"]] = next((t for k, t in of.items() if p[k] == real), "string")
    return out


def typed(df: DataFrame, types: Mapping[str, str], markers: Sequence[str] = MARKERS) -> DataFrame:
    """Text columns cast to ``types``; markers become NULL in every column that is not text."""
    def cast(c: str) -> F.Column:
        v = F.col(f"`{c}`")
        if types[c] == "string":
            return v
        return F.when(~_marker(v, markers), F.trim(v)).try_cast(types[c]).alias(c)

    return df.select(*[cast(c) for c in df.columns])


def read_profiled(spark: SparkSession, path: str, sep: str = ",", markers: Sequence[str] = MARKERS, max_markers: float = 0.5,
                  **options) -> DataFrame:
    """Scan delimited files with a header into typed columns.

    One pass over the files profiles the text columns; the returned frame
    scans them typed, and reads only the columns that are used.
    """
    text = spark.read.option("header", True).option("sep", sep).options(**options).csv(path)
    return typed(text, inferred_types(column_profile(text, markers), max_markers), markers)
