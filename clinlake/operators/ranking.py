"""Distributed running totals over a global order.

A running total (cumulative count or sum in sort order) normally needs a
window with no PARTITION BY, which pulls every row into one task.  Here the
rows are range-partitioned by (group, order columns) into buckets and stored
once in the shared folder with their bucket number; one small aggregate gives
each bucket's total, a window over the bucket totals gives each bucket's
offset, and the per-row running total is a window *within* the bucket plus
that offset.  The number of buckets follows the row count, every step is
distributed, and the only window over whole groups reads one row per bucket.
Exact medians and quantiles, ROC curves and their area, row numbers and
seeded shuffle ranks are built on it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.session import derived_path, discard

# Rows that one bucket's window should hold.
ROWS_PER_BUCKET = 250_000


def in_buckets(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``partition_cols`` and ``order_cols`` and
    stored once, with its bucket number as ``__b``.

    ``n_buckets`` defaults to the session's shuffle partitions; only where
    the stored buckets hold more than ``ROWS_PER_BUCKET`` rows on average (the
    footers tell) is the copy cut into more of them.
    Rows equal on all these columns share a bucket.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*partition_cols, *order_cols)]
    spark = df.sparkSession

    def store(frame: DataFrame, n: int) -> str:
        path = derived_path(spark, "rank-buckets")
        frame.repartitionByRange(n, *keys).withColumn("__b", F.spark_partition_id()).write.parquet(path)
        return path

    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = store(df, n_buckets or tasks)
    rows = spark.read.parquet(path).count() if n_buckets is None else 0  # reads the footers
    if rows > tasks * ROWS_PER_BUCKET:
        first = path
        path = store(spark.read.parquet(first).drop("__b"), -(-rows // ROWS_PER_BUCKET))
        discard(spark, first)
    return spark.read.parquet(path)


def running_total(df: DataFrame, order_cols: Sequence[str], weight_cols: Sequence[str],
                  partition_cols: Sequence[str] = (), n_buckets: int | None = None,
                  prefix: str = "cum_", total_prefix: str | None = None) -> DataFrame:
    """Append ``<prefix><w>``: the sum of ``w`` over all rows up to and including
    this one, ordered by ``order_cols`` (ascending, NULLs first) within
    ``partition_cols`` (a NULL group is a group like others).

    Rows equal on all order columns are ordered arbitrarily, and share a
    bucket.  ``total_prefix`` also appends ``<total_prefix><w>``, the group's
    grand total, taken from the same small per-bucket table.  The input is
    stored in buckets, once (see ``in_buckets``).
    """
    b = in_buckets(df, order_cols, partition_cols, n_buckets)
    return totals_within(b, order_cols, weight_cols, partition_cols, prefix, total_prefix)


def totals_within(b: DataFrame, order_cols: Sequence[str], weight_cols: Sequence[str], partition_cols: Sequence[str] = (),
                  prefix: str = "cum_", total_prefix: str | None = None) -> DataFrame:
    """``running_total`` of rows that are in buckets (``__b``) of these columns already; ``__b`` goes."""
    order_cols, weight_cols, partition_cols = list(order_cols), list(weight_cols), list(partition_cols)
    columns = [c for c in b.columns if c != "__b"]
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    totals = b.groupBy(*partition_cols, "__b").agg(*[F.sum(w).alias(f"__t_{w}") for w in weight_cols])
    before = Window.partitionBy(*partition_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*partition_cols)
    offsets = totals.select(
        *[F.col(c).alias(f"__p{i}") for i, c in enumerate(partition_cols)], F.col("__b").alias("__ob"),
        *[F.coalesce(F.sum(f"__t_{w}").over(before), F.lit(0)).alias(f"__o_{w}") for w in weight_cols],
        *[F.sum(f"__t_{w}").over(whole).alias(f"__g_{w}") for w in weight_cols])

    upto = (Window.partitionBy(*partition_cols, "__b").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col("__b") == F.col("__ob")
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"__p{i}"))
    inside = b.select("*", *[F.sum(w).over(upto).alias(f"__w_{w}") for w in weight_cols])
    return inside.join(offsets, same, "inner").select(
        *[F.col(c) for c in columns],
        *[(F.col(f"__o_{w}") + F.col(f"__w_{w}")).alias(f"{prefix}{w}") for w in weight_cols],
        *[F.col(f"__g_{w}").alias(f"{total_prefix}{w}") for w in (weight_cols if total_prefix else [])])


def exact_quantile_rows(counts: DataFrame, value_col: str, count_col: str, group_cols: Sequence[str],
                        n_buckets: int | None = None) -> DataFrame:
    """Exact median per group from a ``(group..., value, count)`` table.

    Returns ``(group..., median)``: for ``N`` values the mean of the values at
    ranks ``floor((N+1)/2)`` and ``floor(N/2)+1`` (the interpolated median).
    """
    group_cols = list(group_cols)
    r = running_total(counts, [value_col], [count_col], group_cols, n_buckets, prefix="__cum_",
                      total_prefix="__total_")
    r = r.withColumnRenamed(f"__total_{count_col}", "__total")
    cum = F.col(f"__cum_{count_col}")
    first = cum - F.col(count_col) + 1
    k1 = F.floor((F.col("__total") + 1) / 2)
    k2 = F.floor(F.col("__total") / 2) + 1
    hit1 = (first <= k1) & (k1 <= cum)
    hit2 = (first <= k2) & (k2 <= cum)
    v = F.col(value_col)
    return (r.where(hit1 | hit2).groupBy(*group_cols)
            .agg(((F.sum(F.when(hit1, v)) + F.sum(F.when(hit2, v))) / 2).alias("median")))
