"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.sources.schemas import SCHEMAS


def read_csv(spark: SparkSession, path: str, table: str | StructType) -> DataFrame:
    """CSV with a header under a declared schema; an empty field is NULL.

    A malformed value fails the job instead of becoming a silent NULL.
    """
    schema = SCHEMAS[table] if isinstance(table, str) else table
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Name and size in bytes of every file below a directory; file contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(directory)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                F.col("length").alias("size_bytes"))
    )
