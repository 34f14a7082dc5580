"""Ingestion of arriving CSV files into the bronze store with Structured Streaming.

The stream's checkpoint remembers which files were read, so a run takes what has arrived since the
last one and stops. Nothing is held in state: versions of a row are resolved when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.sources.ingest import BronzeStore
from tallyhouse.sources.schemas import SCHEMAS, SourceTable

FILES = "files"
LINE = "_line"
FILE = "_file"


def read_arrivals(store: BronzeStore, entry: SourceTable, folder: str,
                  files_per_batch: int = 1000) -> DataFrame:
    """CSV files of one table as a stream under the declared schema, with the file of each row.

    A line that does not fit the schema has its text in ``_line``; whole lines are parsed, whatever columns
    are asked for.
    """
    return (
        store.spark.readStream.schema(StructType([*SCHEMAS[entry.name], StructField(LINE, StringType())]))
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn(FILE, F.element_at(F.split(F.input_file_name(), "/"), -1))
    )


def rejects_path(store: BronzeStore, entry: SourceTable) -> str:
    return f"{store.root}/_rejects/{entry.name}"


def rejected(store: BronzeStore, entry: SourceTable) -> DataFrame:
    """Lines that no batch could take, with their file."""
    return store.spark.read.parquet(rejects_path(store, entry)).select(LINE, FILE)


def ingest_arrivals(store: BronzeStore, entry: SourceTable, folder: str, checkpoint: str) -> StreamingQuery:
    """Append all files that arrived since the last run, then stop.

    A malformed line does not stop the stream and is no row with silent nulls: it goes to the rejects of its
    table. A micro-batch that is repeated after a failure has the same id and replaces its first attempt.
    """
    def append(rows: DataFrame, batch: int) -> None:
        rows, fits = rows.persist(), F.col(LINE).isNull()
        store.append(rows.filter(fits).drop(LINE, FILE), entry, batch, FILES)
        rows.filter(~fits).select(LINE, FILE).write.mode("overwrite").parquet(
            f"{rejects_path(store, entry)}/batch={batch}")
        rows.unpersist()

    return (
        read_arrivals(store, entry, folder).writeStream
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
