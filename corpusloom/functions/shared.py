"""The one folder that driver and executors share, for what has to be written on the way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Only on one machine (tests, a local master) a temporary folder stands in where that setting is missing;
    on a cluster, where executors would not see each other's files, its absence is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = getattr(context, "_corpusloom_tmp", None)
        if base is None:
            base = context._corpusloom_tmp = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    return f"{base.rstrip('/')}/corpusloom/{what}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def shared_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of a path as the operating system has it; None where the path is another scheme's, a file's or a pattern."""
    files, target = _file_system(spark, path)
    if files.getUri().getScheme() != "file":
        return None
    plain = files.makeQualified(target).toUri().getPath()
    return plain if os.path.isdir(plain) else None


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Results read from ``path`` are lazy, so it goes with the application."""
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def stored(df: DataFrame, what: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut lineage that survives lost executors.

    The folder is deleted when the application ends, or earlier by :func:`discard`.
    """
    spark = df.sparkSession
    path = shared_dir(spark, what)
    df.write.parquet(path, compression=compression)
    remove_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corpusloom_path = path
    return out


def observed(df: DataFrame, what: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`stored`, and aggregates of the rows that were written, from the same pass."""
    seen = Observation()
    out = stored(df.observe(seen, *(c.alias(k) for k, c in metrics.items())), what)
    return out, seen.get


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`stored` wrote for tables that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t._corpusloom_path)
