"""Row numbers and cyclic mini-batches.

A mini-batch learner reads its file round and round: a step takes the next
``batch`` rows, an epoch is a whole number of steps, and where the file's
length is no multiple of the batch the next epoch goes on in the middle of the
file.  Which rows a step takes follows from their place in the file alone, so
every run, retry and partitioning makes the same batches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators.ranking import running_total


def number_rows(df: DataFrame, order_cols: Sequence[str], out: str = "row") -> DataFrame:
    """Append ``out``: the 0-based place of every row in ascending order of
    ``order_cols`` (a key; rows equal on it are numbered arbitrarily).  The
    numbers are running totals over range buckets: no task sees all rows."""
    numbered = running_total(df.withColumn("__one", F.lit(1).cast("long")), list(order_cols), ["__one"], prefix="__upto_")
    return numbered.withColumn(out, F.col("__upto___one") - 1).drop("__one", "__upto___one")


def steps_per_epoch(n_rows: int, batch: int) -> int:
    """Whole batches in the file (one, of repeated rows, where it is shorter than a batch)."""
    return max(1, n_rows // batch)


def cyclic_batches(rows: DataFrame, n_rows: int, batch: int, epochs: int, row_col: str = "row") -> DataFrame:
    """Each numbered row once per use: ``(epoch, step, place)`` and its columns.

    ``rows`` are numbered from 0 to ``n_rows`` - 1.  Use k of row r is position
    r + k ``n_rows`` of the endless file; positions up to ``epochs`` times the
    steps of an epoch are taken.  A narrow projection: no shuffle.
    """
    steps = steps_per_epoch(n_rows, batch)
    last = epochs * steps * batch - 1
    uses = F.when(F.col(row_col) <= last, F.sequence(F.col(row_col), F.lit(last).cast("long"), F.lit(n_rows).cast("long")))
    at = F.col("__at")
    return (rows.withColumn("__at", F.explode(uses))
            .select(F.floor(at / (steps * batch)).alias("epoch"), (F.floor(at / batch) % steps).alias("step"),
                    (at % batch).alias("place"), *[F.col(f"`{c}`") for c in rows.columns]))
