"""Category dictionaries as tables: codes for columns of any number of values.

``features.index_categories`` keeps the labels of a few small columns on the
driver, as Spark's own indexer does.  Here the dictionary is a table: values
are counted, their frequency ranks are running totals over range buckets, and
codes come back by a join.  The most frequent values, at most ``HOT`` rows of
checked size, are broadcast; every other value holds at most one row in
``HOT``, so the join of the rest has no hot key.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators.ranking import running_total
from clinlake.session import materialize

HOT = 1000
#: Most bytes of values that are broadcast for one column.
HOT_BYTES = 8 << 20
# Tasks' worth of places that rows without a value to look up are spread over.
_SPREAD = 1 << 16


def category_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n, code)``: per column the most frequent value has
    code 0, ties in value order; NULL is no value.  Values are compared as
    text.  All columns are counted in one pass, and the result is stored."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])).alias("c"))
    counts = cells.select("c.column", "c.value").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(counts.withColumn("__less", -F.col("n")).withColumn("__one", F.lit(1).cast("long")),
                           ["__less", "value"], ["__one"], ["column"], prefix="__upto_")
    return materialize(ranked.select("column", "value", "n", (F.col("__upto___one") - 1).alias("code")), "dictionary")


def encode(df: DataFrame, cols: Sequence[str], dictionary: DataFrame, suffix: str = "_label", invalid: str = "error",
           hot: int = HOT, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Append ``<c><suffix>``, the int code of each of ``cols``.

    A NULL or a value that the dictionary does not hold raises
    (``invalid="error"``, as the indexer does) or gets NULL (``"null"``).  A
    column with at most ``hot`` values costs no shuffle.
    """
    if invalid not in ("error", "null"):
        raise ValueError("invalid is 'error' or 'null'")
    sizes = (dictionary.where(F.col("column").isin(list(cols))).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("code") < hot, F.octet_length("value"))).alias("bytes")))
    known = {r["column"]: r for r in sizes.collect()}  # bounded: one row a column
    out, names = df, df.columns
    for c in cols:
        words = dictionary.where(F.col("column") == c)
        size = known.get(c)
        few = hot if size is not None and size["bytes"] <= hot_bytes else 0
        value = F.col(f"`{c}`").cast("string")
        parts = []
        if few:
            top = words.where(F.col("code") < few).select(F.col("value").alias("__hot"), F.col("code").alias("__hot_code"))
            out = out.join(F.broadcast(top), value == F.col("__hot"), "left")  # at most ``hot`` rows of ``hot_bytes``
            parts.append(F.col("__hot_code"))
        if size is not None and size["n"] > few:
            # Rows that have their code, and NULLs, are spread out: they meet nothing here.
            wanted = F.when(F.col("__hot_code").isNull(), value) if few else value
            out = out.withColumn("__key", wanted).withColumn("__at", F.when(F.col("__key").isNull(), F.monotonically_increasing_id() % _SPREAD).otherwise(-1))
            rest = words.where(F.col("code") >= few).select(F.col("value").alias("__cold"), F.col("code").alias("__cold_code"), F.lit(-1).cast("long").alias("__side"))
            out = out.join(rest, (F.col("__key") == F.col("__cold")) & (F.col("__at") == F.col("__side")), "left")
            parts.append(F.col("__cold_code"))
        code = reduce(lambda a, b: F.coalesce(a, b), parts) if parts else F.lit(None)
        if invalid == "error":
            code = F.coalesce(code, F.raise_error(F.concat(F.lit(f"no code for a value of {c}: "), F.coalesce(value, F.lit("NULL")))).cast("long"))
        names = [*names, c + suffix]
        out = out.withColumn(c + suffix, code.cast("int")).select(*[F.col(f"`{n}`") for n in names])
    return out
