"""Delimited files with bad records: one scan, good rows and a quarantine.

The files are read once and every line is parsed and checked.  What fits the
schema comes out typed; what does not goes to a table that says where the line
stands and what is wrong with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.session import materialize

_CORRUPT = "__corrupt"


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows of ``schema``, and ``(file, line, reason, text)``.

    A record is one line.  It is bad if its number of fields differs from the
    schema's (``fields``), if a field is not of its type (``<column> is no
    <type>``, the first such column), or if a column that may not be null is
    empty (``<column> is missing``).  Empty fields are NULL.  ``line`` counts
    the lines of each file from 1, the header and blank lines included.  With
    ``header`` the first line of each file must be the schema's names, else
    the read fails, and the same line further down is bad (``header``).  Blank
    lines are skipped.

    The checked lines are stored once, so both outputs come from one scan; line
    numbers are made for bad lines only, from one small row per file split.
    """
    names = schema.fieldNames()
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    fields = F.from_csv("value", ", ".join([f"`{n}` STRING" for n in [*names, _CORRUPT]]),
                        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    text = lambda n: F.col(f"p.`{n}`")
    is_header = F.col("value").isNotNull()
    for n in names:
        is_header = is_header & F.coalesce(text(n) == n, F.lit(False))
    reason = F.when(F.trim("value") == "", F.lit("blank"))
    if header:
        reason = reason.when(is_header, F.lit("header"))
    reason = reason.when(text(_CORRUPT).isNotNull(), F.lit("fields"))
    values = []
    for f in schema.fields:
        given = F.when(text(f.name) != "", text(f.name))
        value = given.try_cast(f.dataType)
        reason = reason.when(given.isNotNull() & value.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = reason.when(given.isNull(), F.lit(f"{f.name} is missing"))
        values.append(value.alias(f.name))
    checked = materialize(lines.withColumn("p", fields).select("file", "split", "at", "value", reason.alias("reason"), F.struct(*values).alias("r")), "checked-lines")
    # One row per file split: where its lines begin, and how its first line was judged.
    splits = checked.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by(F.coalesce("reason", F.lit("")), "at").alias("head"))
    if header:
        other = splits.where((F.col("split") == 0) & (F.col("head") != "header")).select("file").take(1)
        if other:
            raise ValueError(f"the first line of {other[0]['file']} is not the header {sep.join(names)}")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines"))
    wrong = checked.where("reason is not null and reason <> 'blank'").join(begins, ["file", "split"])
    line = F.col("lines") + F.col("at") - F.col("first") + 1
    bad = wrong.select("file", line.alias("line"), "reason", F.col("value").alias("text")).where("reason <> 'header' or line > 1")
    return checked.where("reason is null").select("r.*"), bad
