"""File-stream source and an ``availableNow`` runner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clinlake.session import shared_dir


def read_delimited_stream(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                          header: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over delimited files arriving in ``path``.

    A stream needs a declared schema (no inference pass).  The result works
    with the batch operators unchanged, e.g. ``group_count`` or
    ``conditional_counts`` in complete output mode.
    """
    reader = spark.readStream.schema(schema).option("header", header).option("sep", sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def run_available(df: DataFrame, checkpoint: str, sink_path: str | None = None, output_mode: str = "complete",
                  query_name: str | None = None, fmt: str = "memory"):
    """Process every file available now, then stop; returns the finished query.

    ``checkpoint`` names the stream: its progress lies below the shared folder
    (``spark.checkpoint.dir``) under that name, so a later run with the same
    name goes on where the last one stopped.  ``fmt="memory"`` (with
    ``query_name``) is for small results such as counts; use ``fmt="parquet"``
    with ``sink_path`` and append mode for row outputs.
    """
    spark = df.sparkSession
    writer = (df.writeStream.outputMode(output_mode).format(fmt)
              .option("checkpointLocation", f"{shared_dir(spark)}/clinlake-streams/{checkpoint}")
              .trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    q = writer.start(sink_path) if sink_path else writer.start()
    q.awaitTermination()
    return q
