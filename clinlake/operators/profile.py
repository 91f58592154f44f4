"""Table-size profiling.

The size probes of the original workloads are re-specified as exact payload
sizes: rows times columns with a fixed width per primitive type, UTF-8 length
for text and element widths for arrays/vectors (NULL counts 0).  Plan
statistics are not used: after a join they are products of the input sizes,
not estimates of the result.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clinlake.functions import row_width


def table_size(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_bytes)`` computed in a single aggregation pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_width(df.schema)), F.lit(0))
                  .cast("long").alias("n_bytes"))


def _null_cells(df: DataFrame) -> F.Column:
    parts = [F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table_name, n_rows, n_columns, n_bytes, n_nulls)``.

    Each table is summarised by one aggregate; the one-row results are stacked.
    """
    rows = [df.agg(F.lit(name).alias("table_name"),
                   F.count(F.lit(1)).alias("n_rows"),
                   F.lit(len(df.columns)).alias("n_columns"),
                   F.coalesce(F.sum(row_width(df.schema)), F.lit(0)).cast("long").alias("n_bytes"),
                   F.coalesce(F.sum(_null_cells(df)), F.lit(0)).cast("long").alias("n_nulls"))
            for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def observe_size(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a size probe on it: the job that reads the returned frame
    to its end also measures it, so the probe costs no job of its own.  The
    figures are those of ``table_size``.  Every column counts, so all of them
    are read, whether the job needs them or not.

    Spark keeps observed metrics in the session, which its models with a
    training summary hold and then cannot send to tasks.  The estimators of
    ``operators.models`` drop the summary; drop it from others before scoring
    in a session that observes."""
    probe = Observation(f"{name}-{uuid.uuid4().hex}")
    bytes_ = F.coalesce(F.sum(row_width(df.schema)), F.lit(0)).cast("long")
    return df.observe(probe, F.count(F.lit(1)).alias("n_rows"), bytes_.alias("n_bytes")), probe


def observed_sizes(spark, probes: Mapping[str, Observation]) -> DataFrame:
    """``(step, n_rows, n_bytes)`` of probes whose jobs have run, one row a step
    (``Observation.get`` waits for a job that has not)."""
    rows = [(step, probe.get["n_rows"], probe.get["n_bytes"]) for step, probe in probes.items()]
    return spark.createDataFrame(rows, "step string, n_rows long, n_bytes long")
