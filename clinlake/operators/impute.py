"""Imputation: global median, per-class mean, per-class mode.

Fit/apply, as Spark ML's ``Imputer`` does: each statistic is reduced to ONE
bounded row (all columns, all classes side by side) by a distributed
aggregate, and the fill values are applied as literals in a single
projection with ``coalesce``.  Nothing data-sized moves to the driver or
into one task, a class holding most of the rows is no problem (there is no
join or window keyed on the class), and a chain of imputations stays a
chain of projections over one input instead of nested re-computations.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators.ranking import exact_quantile_rows


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column name, value as double)`` for every non-NULL cell of ``cols``."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("__col"), F.col(f"`{c}`").cast("double").alias("__v")) for c in cols]))
    return df.select(cells.alias("__s")).select("__s.__col", "__s.__v").where(F.col("__v").isNotNull())


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 10000) -> dict:
    """``{column: median}`` for each of ``cols`` (None for an all-NULL column).

    Exact by default (interpolated, like pandas): values are counted per
    (column, distinct value) with map-side combine and ranked with distributed
    running totals, so no task ever holds a whole column.  ``approx=True`` uses
    the bounded-memory ``percentile_approx`` sketch instead (one pass).
    """
    cols = list(cols)
    if approx:
        r = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), 0.5, accuracy).alias(f"m{i}")
                     for i, c in enumerate(cols)]).first()  # bounded: one row
        return dict(zip(cols, r))
    counts = _long_values(df, cols).groupBy("__col", "__v").agg(F.count(F.lit(1)).alias("__n"))
    per_col = exact_quantile_rows(counts, "__v", "__n", ["__col"])
    found = {r["__col"]: r["median"] for r in per_col.collect()}  # bounded: one row per column
    return {c: found.get(c) for c in cols}


def _filled_type(dtype: T.DataType) -> str:
    """Type of a column filled with a mean or median: whole and decimal numbers
    become double (an integer column with gaps has fractional statistics)."""
    return dtype.simpleString() if isinstance(dtype, (T.DoubleType, T.FloatType)) else "double"


def _lit(value, dtype: str) -> F.Column:
    return F.lit(value).cast(dtype)


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool = False,
                  stats_from: DataFrame | None = None, values: dict | None = None) -> DataFrame:
    """Fill NULLs of ``cols`` with the column median (whole-number columns become double).

    The medians come from ``values`` (already fitted), else from
    ``stats_from`` when given (e.g. the training part, to keep test rows out
    of the statistic), else from ``df`` itself.
    """
    cols = list(cols)
    med = values if values is not None else medians(stats_from if stats_from is not None else df, cols, approx)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast(t), _lit(med[c], t))
                           for c in cols for t in [_filled_type(df.schema[c].dataType)]})


def _by_class(label: str, classes: Sequence, values: Sequence, dtype: str) -> F.Column:
    """CASE label WHEN class_i THEN value_i END (values inlined as literals)."""
    expr = None
    for cls, val in zip(classes, values):
        cond = F.col(f"`{label}`") == F.lit(cls)
        expr = F.when(cond, _lit(val, dtype)) if expr is None else expr.when(cond, _lit(val, dtype))
    return expr


def class_mean_columns(label: str, cols: Sequence[str], classes: Sequence = (0, 1)) -> list:
    """The conditional-average aggregate columns behind ``class_means`` (so they
    can share one pass with other statistics)."""
    lab = F.col(f"`{label}`")
    return [F.avg(F.when(lab == F.lit(k), F.col(f"`{c}`"))).alias(f"__mean_{j}_{i}")
            for j, c in enumerate(cols) for i, k in enumerate(classes)]


def read_class_means(row, cols: Sequence[str], classes: Sequence = (0, 1)) -> dict:
    return {c: [row[f"__mean_{j}_{i}"] for i in range(len(classes))] for j, c in enumerate(cols)}


def class_means(df: DataFrame, label: str, cols: Sequence[str], classes: Sequence = (0, 1)) -> dict:
    """``{column: [mean of class_0, mean of class_1, ...]}`` from one global
    aggregate of conditional averages (one row)."""
    cols, classes = list(cols), list(classes)
    r = df.agg(*class_mean_columns(label, cols, classes)).first()  # bounded: one row
    return read_class_means(r, cols, classes)


def impute_mean_by(df: DataFrame, label: str, cols: Sequence[str], classes: Sequence = (0, 1),
                   stats_from: DataFrame | None = None, means: dict | None = None) -> DataFrame:
    """Fill NULLs of ``cols`` with the mean of the row's class (whole-number
    columns become double).

    Rows whose label is not one of ``classes`` are dropped (the class slices
    are the whole output).  The means come from ``means`` (already fitted),
    else from ``stats_from`` when given, else from ``df``.
    """
    cols, classes = list(cols), list(classes)
    if means is None:
        means = class_means(stats_from if stats_from is not None else df, label, cols, classes)
    kept = df.where(F.col(f"`{label}`").isin(classes))
    return kept.withColumns({c: F.coalesce(F.col(f"`{c}`").cast(t), _by_class(label, classes, means[c], t))
                             for c in cols for t in [_filled_type(df.schema[c].dataType)]})


def class_modes(df: DataFrame, label: str, cols: Sequence[str], classes: Sequence = (0, 1)) -> dict:
    """``{column: [mode of class_0, ...]}``: most frequent non-NULL value of each
    column within each class; ties go to the lowest value.

    All columns in one pass: cells are unpivoted to ``(column, value)``,
    counted per class with conditional counts (map-side combine absorbs hot
    values), and ``min(struct(-count, value))`` per column picks the winner.
    Numeric columns order by their numeric value, text by its text.  The value
    itself travels as exact text, so no type loses digits.  Both steps are
    ordinary aggregates; no group is ever collected, and the result has one
    row per column.
    """
    cols, classes = list(cols), list(classes)
    lab = F.col(f"`{label}`")
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c for c in cols if isinstance(types[c], T.NumericType)}
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"),
                 (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
                 # Long and decimal values that are one double still order by their value.
                 (F.col(f"`{c}`").try_cast("decimal(38,10)") if c in numeric else F.lit(None).cast("decimal(38,10)")).alias("fine"),
                 F.col(f"`{c}`").cast("string").alias("txt"))
        for c in cols]))
    long = (df.where(lab.isin(classes)).select(lab.alias("__lab"), cells.alias("__s"))
            .select("__lab", "__s.*").where(F.col("txt").isNotNull()))
    counts = long.groupBy("c", "num", "fine", "txt").agg(
        *[F.count_if(F.col("__lab") == F.lit(k)).alias(f"n{i}") for i, k in enumerate(classes)])
    winners = counts.groupBy("c").agg(*[
        F.min(F.when(F.col(f"n{i}") > 0, F.struct((-F.col(f"n{i}")).alias("neg"), "num", "fine", "txt"))).alias(f"m{i}")
        for i in range(len(classes))])
    found = {r["c"]: r for r in winners.collect()}  # bounded: one row per column
    out = {}
    for c in cols:
        kind = (float if isinstance(types[c], (T.DoubleType, T.FloatType)) else Decimal if isinstance(types[c], T.DecimalType)
                else int if c in numeric else str)
        won = [found[c][f"m{i}"] if c in found else None for i in range(len(classes))]
        out[c] = [None if w is None else kind(w["txt"]) for w in won]
    return out


def impute_mode_by(df: DataFrame, label: str, cols: Sequence[str], classes: Sequence = (0, 1),
                   stats_from: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of ``cols`` with the class mode (ties -> lowest value); the
    modes come from ``stats_from`` when given."""
    cols, classes = list(cols), list(classes)
    types = dict(df.dtypes)
    modes = class_modes(stats_from if stats_from is not None else df, label, cols, classes)
    kept = df.where(F.col(f"`{label}`").isin(classes))
    return kept.withColumns({c: F.coalesce(F.col(f"`{c}`"), _by_class(label, classes, modes[c], types[c]))
                             for c in cols})
