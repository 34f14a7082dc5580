"""Stored tables and views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, name: str, comment: str | None = None,
                partition_by: Iterable[str] = ()) -> DataFrame:
    """Replace a managed table with the rows of ``df`` and return the stored table.

    Partition columns get one shuffle on themselves plus a spread, so a partition is written by a
    bounded number of tasks and not by a single one when it holds most rows.
    """
    spark = df.sparkSession
    partitions = list(partition_by)
    if partitions:
        df = df.hint("rebalance", *[F.col(c) for c in partitions])
    writer = df.write.mode("overwrite").format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)
    if comment is not None:
        escaped = comment.replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{escaped}'")
    return spark.table(name)


def overwrite_partitions(df: DataFrame, name: str) -> DataFrame:
    """Replace only those partitions of an existing table for which ``df`` has rows.

    ``insertInto`` takes the overwrite mode from the session, so it is set for this write only.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    usual = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, usual)
    return spark.table(name)


def clear_partitions(spark: SparkSession, name: str, column: str, values: Iterable[object]) -> None:
    """Take all rows out of some partitions of a table that is partitioned by one date column.

    An overwrite with rows leaves a partition alone for which there are none any more.
    """
    nothing = spark.createDataFrame([], spark.table(name).drop(column).schema)
    for value in values:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = DATE '{value}') SELECT * FROM {{nothing}}",
                  nothing=nothing)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def stored_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame | None]:
    """Each expected table, or None where the catalog does not have it."""
    return {n: spark.table(n) if spark.catalog.tableExists(n) else None for n in names}


def load_audit(tables: Mapping[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Rows per expected table, MISSING where absent, and a TOTAL row."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit("LOADED").alias("status"))
        for name, df in tables.items() if df is not None
    ]
    absent = [(name, None, "MISSING") for name, df in tables.items() if df is None]
    if absent:
        counts.append(spark.createDataFrame(absent, "table_name STRING, row_count BIGINT, status STRING"))
    audit = reduce(DataFrame.unionByName, counts)
    total = F.grouping("table_name") == 1
    return audit.rollup("table_name").agg(
        F.sum("row_count").alias("row_count"),
        F.when(total, F.lit("TOTAL")).otherwise(F.max("status")).alias("status"),
    ).select(F.when(F.col("table_name").isNull(), F.lit("TOTAL")).otherwise(F.col("table_name")).alias("table_name"),
             "row_count", "status")
