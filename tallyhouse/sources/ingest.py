"""Incremental ingestion of the source tables into a bronze store.

Each table is a log of batches under one folder: a run appends what is new and never rewrites what is there.
A batch counts from the moment that its mark is written, a single file. The current state of a table is the
newest version per key over the log; a key whose newest version is a tombstone is not in it. Compaction writes
that state down once, so that later reads take it and the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.lineage import delete_folder
from tallyhouse.sources.incremental import (
    DELETED, changed_rows, extract_since, high_water_mark, latest_per_key, missing_keys, snapshot_changes)
from tallyhouse.sources.schemas import MANIFEST, SourceTable

BATCH = "batch_id"
ORIGIN = "origin"
EXTRACT = "extract"
SNAPSHOT = "snapshot"


@dataclass(frozen=True)
class BronzeStore:
    """Batches are numbered per origin, so an extract and a file stream can feed the same table."""

    spark: SparkSession
    root: str

    def log_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _small(self, path: str) -> DataFrame | None:
        """Rows that the store keeps about its batches, or None before the first."""
        try:
            return self.spark.read.option("basePath", path).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _marks(self, entry: SourceTable, origin: str | None = None) -> DataFrame | None:
        """One stored row per batch."""
        marks = self._small(f"{self.root}/_marks/{entry.name}")
        return marks if marks is None or origin is None else marks.filter(F.col(ORIGIN) == origin)

    def append(self, rows: DataFrame, entry: SourceTable, batch: int, origin: str = EXTRACT) -> bool:
        """Write one batch and then its mark, and tell whether it has rows; one without rows gets no mark.

        Writing the same batch again replaces it. The rows are computed once.
        """
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        folder = f"{self.log_path(entry.name)}/{ORIGIN}={origin}/{BATCH}={batch}"
        rows.write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        if written.isEmpty():
            delete_folder(self.spark, folder)
            return False
        high_water_mark(written, entry.cursor).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/_marks/{entry.name}/{ORIGIN}={origin}/{BATCH}={batch}")
        return True

    def mark(self, entry: SourceTable, origin: str = EXTRACT) -> object | None:
        """Largest cursor value that this origin has delivered."""
        marks = self._marks(entry, origin)
        return None if marks is None else marks.agg(F.max("high_water_mark")).first()[0]

    def next_batch(self, entry: SourceTable, origin: str = EXTRACT) -> int:
        marks = self._marks(entry, origin)
        return 0 if marks is None else marks.agg(F.coalesce(F.max(BATCH), F.lit(-1)) + 1).first()[0]

    def _compacted(self, entry: SourceTable) -> tuple[int, dict[str, int]]:
        """Number of the newest snapshot, -1 for none, and the last batch of each origin that it holds."""
        pointers = self._small(f"{self.root}/_pointers/{entry.name}")
        if pointers is None:
            return -1, {}
        rows = pointers.collect()
        newest = max(row[SNAPSHOT] for row in rows)
        return newest, {row[ORIGIN]: row[BATCH] for row in rows if row[SNAPSHOT] == newest}

    def log(self, entry: SourceTable) -> DataFrame:
        """Versions of rows that tell the current state: the newest snapshot and the batches after it.

        The driver lists one row per batch, and no folder of the batches before.
        """
        marks = self._marks(entry)
        if marks is None:
            raise ValueError(f"no batch of {entry.name} yet")
        newest, upto = self._compacted(entry)
        base = self.log_path(entry.name)
        tail = [f"{base}/{ORIGIN}={r[ORIGIN]}/{BATCH}={r[BATCH]}" for r in marks.select(ORIGIN, BATCH).collect()
                if r[BATCH] > upto.get(r[ORIGIN], -1)]
        parts = [self.spark.read.parquet(f"{self.root}/_snapshots/{entry.name}/{SNAPSHOT}={newest}")] if newest >= 0 else []
        if tail:
            parts.append(self.spark.read.option("basePath", base).parquet(*tail).withColumns(
                {BATCH: F.col(BATCH).cast("bigint"), ORIGIN: F.col(ORIGIN).cast("string")}))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def current(self, entry: SourceTable, origin: str | None = None, mark: object | None = None,
                overlap: object | None = None) -> DataFrame:
        """The newest version of every row: by cursor, and by batch where the cursor is the same.

        With ``origin`` it is what this origin has delivered. With ``mark`` only versions beyond it less the
        overlap are looked at, and so only rows whose newest version lies there are right.
        """
        log = extract_since(self.log(entry), entry.cursor, mark, overlap)
        if origin is not None:
            log = log.filter(F.col(ORIGIN) == origin)
        newest = latest_per_key(log, entry.primary_key, entry.cursor, BATCH)
        return newest.filter(~F.col(DELETED)).drop(BATCH, ORIGIN, DELETED)

    def compact(self, entry: SourceTable) -> None:
        """Write down the newest version per key and origin, tombstones included, as the base of later reads.

        The pointer is a single file that is written last; until then, and if the run dies, reads go by the
        former one. Tombstones stay, so that an older version that arrives late does not bring a row back.
        """
        marks = self._marks(entry)
        if marks is None:
            return
        newest, _ = self._compacted(entry)
        upto = marks.groupBy(ORIGIN).agg(F.max(BATCH).cast("bigint").alias(BATCH)).collect()
        resolved = latest_per_key(self.log(entry), entry.primary_key, entry.cursor, BATCH, within=(ORIGIN,))
        resolved.write.mode("overwrite").parquet(f"{self.root}/_snapshots/{entry.name}/{SNAPSHOT}={newest + 1}")
        self.spark.createDataFrame([(r[ORIGIN], r[BATCH]) for r in upto], f"{ORIGIN} STRING, {BATCH} BIGINT").coalesce(1) \
            .write.parquet(f"{self.root}/_pointers/{entry.name}/{SNAPSHOT}={newest + 1}")


def _news(store: BronzeStore, rows: DataFrame, entry: SourceTable, overlap: object | None, deletions: bool) -> DataFrame:
    """What an extract brings that the store has not had from it."""
    mark = store.mark(entry)
    if mark is None:
        return rows
    key, cursor = entry.primary_key, entry.cursor
    if cursor == key:
        known = store.current(entry, EXTRACT).select(*rows.columns)
        return snapshot_changes(rows, known, key, cursor) if deletions else changed_rows(rows, known, key)
    recent = extract_since(rows, cursor, mark, overlap)
    known = store.current(entry, EXTRACT, mark, overlap).select(*rows.columns)
    news = changed_rows(recent, known, key)
    if not deletions:
        return news
    everything = store.current(entry, EXTRACT).select(*rows.columns)
    return news.withColumn(DELETED, F.lit(False)).unionByName(missing_keys(everything, rows, key, cursor))


def ingest_bronze(store: BronzeStore, source: Callable[[str], DataFrame],
                  manifest: Iterable[SourceTable] = MANIFEST, overlap: object | None = None,
                  deletions: bool = False) -> None:
    """Append what is new in every source table; ``source`` reads a table by name.

    Where the cursor tells updates, rows beyond the mark less ``overlap`` are read, and of those the ones
    that the store does not hold as they are. Where the cursor is the key itself, the whole table is
    compared with the store, so changed and late rows arrive too. With ``deletions``, rows that an extract
    delivered before and that the source lacks now are marked as deleted; that reads the key of every source
    row. A table without news gets no batch.
    """
    for entry in manifest:
        store.append(_news(store, source(entry.name), entry, overlap, deletions), entry, store.next_batch(entry))
