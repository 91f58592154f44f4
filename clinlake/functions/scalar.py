"""Scalar column expressions.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: ColumnOrName) -> Column:
    """Tolerant cast to int: text markers become NULL, decimals truncate toward zero.

    ``'36.6' -> 36``, ``'N/A' -> NULL``, ``'28' -> 28``.  Going through double
    keeps decimals (a direct ``try_cast(int)`` would turn ``'36.6'`` into NULL)
    and ``try_cast`` keeps ANSI mode from raising on bad input or overflow.
    """
    return _col(c).try_cast("double").try_cast("int")


def case_bucket(c: ColumnOrName, rules: Sequence[tuple], default) -> Column:
    """First-match CASE bucketing.

    ``rules`` is a list of ``(predicate_builder, label)`` where the builder
    takes the column and returns a boolean Column.  Rows where no predicate is
    true (including NULL input) get ``default``.
    """
    x = _col(c)
    expr = None
    for pred, label in rules:
        cond = pred(x)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def is_neither(c: ColumnOrName, values: Iterable) -> Column:
    """``c`` is non-NULL and none of ``values`` (NULL rows are not counted)."""
    return ~_col(c).isin(list(values))


def text_match_any(cols: Sequence[ColumnOrName], needle: str) -> Column:
    """Case-sensitive substring test over several text columns (three-valued OR)."""
    return reduce(lambda a, b: a | b, [_col(c).contains(needle) for c in cols])


def null_if_sentinel(c: ColumnOrName, values: Sequence[float], dtype: T.DataType | None = None) -> Column:
    """Map sentinel values (and NaN for floating types) to NULL."""
    x = _col(c)
    cond = x.isin(list(values))
    if dtype is None or isinstance(dtype, (T.DoubleType, T.FloatType)):
        cond = F.isnan(x) | cond
    return F.when(cond, F.lit(None)).otherwise(x)


def round_exact(c: ColumnOrName, digits: int = 2) -> Column:
    """Round a double as Python's ``round``: the exact binary value decides, and
    exact halves go to the even digit.

    The product with ``10**digits`` is split into its rounded value and its
    rounding error (both exact), so 2.675 (just below the half) gives 2.67 and
    0.125 gives 0.12.  Values of 2**53 / 10**digits and more have no such
    digits and stay.
    """
    if not 0 <= digits <= 7:
        raise ValueError("0 to 7 digits")
    x, s = _col(c).cast("double"), float(10**digits)
    a = F.abs(x)
    high = F.lit(134217729.0) * a
    high = high - (high - a)
    product = a * F.lit(s)
    error = (high * F.lit(s) - product) + (a - high) * F.lit(s)
    below = F.floor(product).cast("double")
    past = (product - below - F.lit(0.5)) + error
    up = (past > 0) | ((past == 0) & (below % 2 == 1))
    rounded = F.signum(x) * (below + F.when(up, 1.0).otherwise(0.0)) / F.lit(s)
    return F.when(a < F.lit(2.0**53 / s), rounded).otherwise(x)


def ratio_round(num: ColumnOrName, den: ColumnOrName, scale: float = 10000.0, digits: int = 2) -> Column:
    """``round(num / den**2 * scale, digits)`` as Python rounds; zero denominator -> NULL."""
    d = _col(den).cast("double")
    return round_exact(F.try_divide(_col(num).cast("double"), d * d) * F.lit(scale), digits)


def argmax_array(c: ColumnOrName) -> Column:
    """0-based index of the first maximum of an array column."""
    a = _col(c)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


# What a NULL key hashes as.
NULL_KEY = "<null>"


def _md5_hex(key: ColumnOrName, seed) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(_col(key).cast("string"), F.lit(NULL_KEY))))


def hash_bucket(key: ColumnOrName, seed, modulus: int = 10000) -> Column:
    """Deterministic bucket in ``[0, modulus)`` from md5 of ``'<seed>:<key>'``.

    Uses the first 8 hex digits (32 bits), so the result does not depend on
    partitioning or row order; a SQL engine reproduces it with ``md5``.
    """
    h = F.conv(F.substring(_md5_hex(key, seed), 1, 8), 16, 10).cast("long")
    return (h % F.lit(modulus)).cast("int")


def hash_order_key(key: ColumnOrName, seed) -> Column:
    """60-bit ordering key from md5 of ``'<seed>:<key>'`` (for seeded shuffles)."""
    return F.conv(F.substring(_md5_hex(key, seed), 1, 15), 16, 10).cast("long")


_FIXED_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}


def _fixed_width(dt: T.DataType) -> int | None:
    for cls, w in _FIXED_WIDTH.items():
        if isinstance(dt, cls):
            return w
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    return None


def value_width(c: Column, dt: T.DataType) -> Column:
    """Payload bytes of one value: fixed width per primitive, UTF-8 length for text,
    element widths summed for arrays; NULL counts 0."""
    w = _fixed_width(dt)
    if w is not None:
        return F.when(c.isNull(), F.lit(0)).otherwise(F.lit(w)).cast("long")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c).cast("long"), F.lit(0).cast("long"))
    if isinstance(dt, T.ArrayType):
        ew = _fixed_width(dt.elementType)
        if ew is not None:
            return F.coalesce(F.size(c).cast("long") * F.lit(ew), F.lit(0).cast("long"))
        return F.coalesce(
            F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + value_width(x, dt.elementType)),
            F.lit(0).cast("long"))
    if isinstance(dt, T.StructType):
        parts = [value_width(c.getField(f.name), f.dataType) for f in dt.fields]
        return reduce(lambda a, b: a + b, parts, F.lit(0).cast("long"))
    from pyspark.ml.linalg import VectorUDT
    if isinstance(dt, VectorUDT):
        # counted as its dense equivalent: one double per dimension
        from pyspark.ml.functions import vector_to_array
        return F.coalesce(F.size(vector_to_array(c)).cast("long") * F.lit(8), F.lit(0).cast("long"))
    raise TypeError(f"no width rule for {dt.simpleString()}")


def row_width(schema: T.StructType) -> Column:
    """Sum of value widths over all top-level columns of ``schema``."""
    parts = [value_width(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields]
    return reduce(lambda a, b: a + b, parts, F.lit(0).cast("long"))
