"""Cleaning and binning: sentinels, constant fills, casts, interaction terms, bins."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions import case_bucket, null_if_sentinel, to_int

# The missing-value sentinels of the ICU recipe.
DEFAULT_SENTINELS = (-1.0, float("inf"), float("-inf"))


def null_sentinels(df: DataFrame, cols: Sequence[str] | None = None,
                   values: Sequence[float] = DEFAULT_SENTINELS) -> DataFrame:
    """Turn sentinel values (and NaN) into NULL on ``cols`` (default: all numeric
    columns) in one projection, so later averages and medians skip them."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = set(cols if cols is not None else
               [n for n, t in types.items() if isinstance(t, T.NumericType)])
    return df.select(*[
        null_if_sentinel(F.col(f"`{n}`"), values, types[n]).alias(n) if n in cols else F.col(f"`{n}`")
        for n in df.columns])


def tolerant_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast ``cols`` to int tolerantly (text markers -> NULL, decimals truncate)."""
    return df.withColumns({c: to_int(c) for c in cols})


def constant_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULL (and NaN in floating columns) with per-column constants."""
    return df.na.fill(dict(values))


def interaction_features(df: DataFrame, flag: tuple[str, str, str],
                         scaled: tuple[str, str, str], scale: float = 1000.0) -> DataFrame:
    """Append a product flag ``a*b`` (bigint) and a scaled product ``c*d/scale`` (double).

    ``flag`` and ``scaled`` are ``(left, right, output_name)``; operands are
    widened first so an int x int product cannot overflow under ANSI mode.
    """
    a, b, fname = flag
    c, d, sname = scaled
    return df.withColumns({
        fname: F.col(a).cast("long") * F.col(b).cast("long"),
        sname: F.col(c).cast("double") * F.col(d).cast("double") / F.lit(scale),
    })


def age_bands(c: str = "age"):
    """The stroke recipe's age bands.  Age 30 exactly, 40 and above, and NULL
    all fall in ``OldAge`` (first-match CASE with an open boundary)."""
    # Band labels and limits of the stroke recipe.
    return case_bucket(c, [(lambda x: x < 30, "Adult"),
                           (lambda x: (x > 30) & (x < 40), "MiddleAge")], "OldAge")


def min_max(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    """Observed range of ``col`` from one distributed aggregate."""
    r = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()  # bounded: one row
    return r.lo, r.hi


def equal_width_edges(lo: float, hi: float, k: int) -> list[float]:
    """The ``k + 1`` edges of pandas' ``cut(x, bins=k)``: evenly spaced, the lowest
    moved down by a thousandth of the range so that the minimum falls inside."""
    if lo == hi:
        lo, hi = lo - (0.001 * abs(lo) if lo else 0.001), hi + (0.001 * abs(hi) if hi else 0.001)
    step = (hi - lo) / k
    return [lo - (hi - lo) * 0.001] + [i * step + lo for i in range(1, k)] + [hi]


def equal_width_bin(df: DataFrame, col: str, labels: Sequence[str], index_col: str,
                    label_col: str | None = None, bounds: tuple | None = None,
                    stats_from: DataFrame | None = None) -> DataFrame:
    """Equal-width bins over the observed range, right-closed: pandas' ``cut(x, bins=k)``.

    Fit: one global ``min/max`` aggregate (or ``bounds`` given), from which the
    edges follow.  Apply: the number of inner edges below the value, with the
    edges inlined as literals.  NULL stays NULL.  ``labels`` only name the
    bins; the edges come from the data (of ``stats_from`` when given, e.g. the
    training part; values beyond that range go to the outer bins).
    """
    lo, hi = bounds if bounds is not None else min_max(stats_from if stats_from is not None else df, col)
    x = F.col(col).cast("double")
    if lo is None:
        idx = F.lit(None).cast("int")
    else:
        inner = F.array(*[F.lit(float(e)) for e in equal_width_edges(lo, hi, len(labels))[1:-1]]).cast("array<double>")
        idx = F.when(x.isNotNull(), F.size(F.filter(inner, lambda e: e < x)))
    out = df.withColumn(index_col, idx)
    if label_col:
        names = F.array(*[F.lit(s) for s in labels])
        out = out.withColumn(label_col, F.when(F.col(index_col).isNotNull(),
                                               F.element_at(names, F.col(index_col) + 1)))
    return out


def edge_bin(df: DataFrame, col: str, inner_edges: Sequence[float], labels: Sequence[str],
             out_col: str, lowest: str = "null", bounds: tuple | None = None,
             stats_from: DataFrame | None = None) -> DataFrame:
    """Bins with data-driven outer edges ``[min, *inner_edges, max]``, right-closed.

    As in pandas' ``cut`` with explicit bins, a row equal to the minimum falls
    outside every bin and gets NULL (``lowest="include"`` puts it in the first
    bin instead).  Edges that do not increase (``min >= inner_edges[0]`` or
    ``max <= inner_edges[-1]``) raise ``ValueError`` when the range is fitted
    (on ``stats_from`` when given).
    """
    if len(labels) != len(inner_edges) + 1:
        raise ValueError("need one label per bin")
    lo, hi = bounds if bounds is not None else min_max(stats_from if stats_from is not None else df, col)
    x = F.col(col).cast("double")
    if lo is None:
        return df.withColumn(out_col, F.lit(None).cast("string"))
    if lo >= inner_edges[0] or hi <= inner_edges[-1]:
        raise ValueError(f"bin edges for {col} must increase: {[lo, *inner_edges, hi]}")
    below = x <= F.lit(lo) if lowest == "null" else x < F.lit(lo)
    expr = F.when(x.isNull() | below, F.lit(None))
    for edge, lab in zip(inner_edges, labels[:-1]):
        expr = expr.when(x <= F.lit(float(edge)), F.lit(lab))
    expr = expr.when(x <= F.lit(hi), F.lit(labels[-1]))
    return df.withColumn(out_col, expr.cast("string"))
