"""Session helpers: a tuned SparkSession, the shared folder and its life cycle."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every workload in this package.  AQE re-plans
# joins and coalesces shuffle partitions at run time; skew-join splitting
# guards sort-merge joins against hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Derived folders of this driver process, by application; ``cleanup`` empties it.
_OWN: dict[str, list[str]] = {}
_KEPT: dict[tuple, str] = {}
# Shared folders named without a file system, by application and name.
_QUALIFIED: dict[tuple, str] = {}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "clinlake", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for derived tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (falling back to the context's
    checkpoint dir).  A path without a scheme lies on the default file system,
    as everywhere in Spark.  Where that is the machines' own, a cluster's
    executors must see what the driver puts there (a mount, or one machine):
    else their files would be lost without an error, so it is refused.
    Tests set their own before the session starts.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    if not re.match(r"local(\[|$)", spark.sparkContext.master) and not re.match(r"[A-Za-z][\w+.-]*:", path):
        path = _on_default_fs(spark, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def _on_default_fs(spark: SparkSession, path: str) -> str:
    """``path`` with its file system; a local one is tried once per application."""
    where = (spark.sparkContext.applicationId, path)
    if where not in _QUALIFIED:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        whole = fs.makeQualified(at).toString()
        if whole.startswith("file:") and not _seen_by_executors(spark, fs, whole):
            raise RuntimeError(f"spark.checkpoint.dir is {path!r}, a folder that executors do not share; on a cluster name a shared one (hdfs:, s3a:, or a mount)")
        _QUALIFIED[where] = whole
    return _QUALIFIED[where]


def _seen_by_executors(spark: SparkSession, fs, folder: str) -> bool:
    """Whether a mark that the driver leaves in a local folder is there in a task on every core."""
    sc = spark.sparkContext
    mark = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/clinlake/mark-{uuid.uuid4().hex}")
    fs.create(mark).close()
    file, n = mark.toUri().getPath(), max(1, sc.defaultParallelism)
    try:
        return all(sc.parallelize(range(n), n).map(lambda _: os.path.exists(file)).collect())  # bounded: one flag a core
    finally:
        fs.delete(mark, False)


def derived_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder; ``cleanup`` removes it."""
    path = f"{shared_dir(spark)}/clinlake/{name}-{uuid.uuid4().hex}"
    _OWN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df, name: str = "stage"):
    """Cut the lineage of ``df`` by writing it as a parquet table in the shared folder.

    Used at stage boundaries of multi-statistic recipes, where every later
    statistic would otherwise re-run the whole upstream plan.  Parquet (rather
    than an RDD checkpoint of serialized rows) lets each later statistic read
    only the columns it needs with the vectorized reader and pushed filters.
    The files live under ``spark.checkpoint.dir`` (shared storage), so losing
    an executor does not lose the stage.  They stay until ``cleanup``, because
    the returned frame is lazy.
    """
    spark = df.sparkSession
    path = derived_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def kept_path(spark: SparkSession, key: tuple, write) -> str:
    """A derived folder that several queries of this application share:
    ``write(path)`` runs the first time, later calls get the same path (until
    ``cleanup``)."""
    where = (spark.sparkContext.applicationId, *key)
    if where not in _KEPT:
        path = derived_path(spark, str(key[0]))
        write(path)
        _KEPT[where] = path
    return _KEPT[where]


def kept(spark: SparkSession, key: tuple, build) -> DataFrame:
    """``kept_path`` for a table: ``build()`` is stored once as parquet."""
    return spark.read.parquet(kept_path(spark, key, lambda path: build().write.mode("errorifexists").parquet(path)))


def cleanup(spark: SparkSession) -> int:
    """Delete the derived folders that this application has made and return how
    many there were.  Call it when the results are consumed: frames that read
    the folders stop working.  Folders of other applications are not touched."""
    app = spark.sparkContext.applicationId
    paths = _OWN.pop(app, [])
    for where in [k for k in _KEPT if k[0] == app]:
        del _KEPT[where]
    for p in paths:
        _delete(spark, p)
    return len(paths)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one derived folder of this application whose readers are done."""
    _OWN[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
