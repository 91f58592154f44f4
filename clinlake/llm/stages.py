"""Stage tables of the operators: written to the shared folder and read back.

A finished stage is a parquet table below ``spark.checkpoint.dir``; losing an
executor afterwards costs nothing, and the shuffle files that led to it are
no longer needed.  `write` lets Spark drop them when the write ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinlake.session import derived_path, shared_dir

# Spark's own setting: drop a statement's shuffle files when the statement ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` as a parquet table and drop the shuffle files behind it."""
    conf = df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES, None)
    conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        conf.unset(DROP_SHUFFLES) if before is None else conf.set(DROP_SHUFFLES, before)


def store(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it."""
    path = derived_path(df.sparkSession, name)
    write(df, path, *partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete a stage table once its readers are done.

    Only files below the library's own folder in the shared folder go.
    """
    spark = df.sparkSession
    own = shared_dir(spark).split(":", 1)[-1].lstrip("/") + "/clinlake/"
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        while "=" in path.getName():
            path = path.getParent()
        if own in path.toString():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions that the session names."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of a whole text column (one aggregate row)."""
    from pyspark.sql import functions as F

    return df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
