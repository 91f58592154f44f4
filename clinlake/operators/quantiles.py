"""Exact quantiles of several columns in one pass, and binning by them."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators.impute import _long_values
from clinlake.operators.ranking import running_total


def exact_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``(column, probability, value)``: the smallest value whose share of the
    column's rows, up to and including it, reaches the probability.

    NULL and NaN are no values; a column without any has no rows.  Values are
    counted per column and distinct value, and all ranks of all columns are
    read from one running total: no task holds a column.
    """
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    counts = _long_values(df, cols).where(~F.isnan("__v")).groupBy("__col", "__v").agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_total(counts, ["__v"], ["__n"], ["__col"], prefix="__upto", total_prefix="__all")
    total, upto = F.col("__all__n"), F.col("__upto__n")
    # The rank of p among n values is n - floor(n - p n), one at least.
    ranks = [F.struct(F.lit(float(p)).alias("probability"),
                      F.greatest(F.lit(1), total - F.floor(total - F.lit(float(p)) * total)).alias("rank")) for p in dict.fromkeys(probabilities)]
    hits = ranked.select("__col", "__v", "__n", upto.alias("upto"), F.explode(F.array(*ranks)).alias("r"))
    return hits.where((F.col("r.rank") <= F.col("upto")) & (F.col("r.rank") > F.col("upto") - F.col("__n"))).select(
        F.col("__col").alias("column"), "r.probability", F.col("__v").alias("value"))


def quantile_edges(df: DataFrame, cols: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    """The distinct inner edges of ``n_bins`` bins of about equal size, ascending, by column."""
    shares = [i / n_bins for i in range(1, n_bins)]
    found: dict[str, set] = {c: set() for c in cols}
    for r in exact_quantiles(df, cols, shares).collect() if shares else []:  # bounded: columns times bins
        found[r["column"]].add(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def quantile_bins(df: DataFrame, cols: Sequence[str], n_bins: int, suffix: str = "_bin", edges: Mapping[str, Sequence[float]] | None = None,
                  stats_from: DataFrame | None = None) -> DataFrame:
    """Append ``<c><suffix>``, the int bin of each of ``cols``: how many inner
    edges are at or below the value.  Columns with few values get fewer bins;
    NULL and NaN get NULL.  Edges come from ``edges``, ``stats_from`` or ``df``
    itself, and are applied as literals."""
    known = edges if edges is not None else quantile_edges(stats_from if stats_from is not None else df, cols, n_bins)

    def bin_of(c: str) -> F.Column:
        v = F.col(f"`{c}`").cast("double")
        at = reduce(lambda a, b: a + b, [F.when(v >= F.lit(float(e)), 1).otherwise(0) for e in known[c]], F.lit(0))
        return F.when(v.isNotNull() & ~F.isnan(v), at).cast("int")

    return df.withColumns({c + suffix: bin_of(c) for c in cols})
