"""Reliable checkpoints and intermediate tables in the folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_made: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, a folder below the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows once and go on from the stored copy, which survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, known to ``clear_scratch``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark's file systems give it, as a URI that other readers take as well.

    A path without scheme lies in Spark's default file system, wherever that is.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and "://" not in whole else whole


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark writes to; one that is not there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what was written below paths from ``scratch_path``. Frames that read from there end with it."""
    while _made:
        delete_folder(spark, _made.pop())
