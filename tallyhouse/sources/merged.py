"""A stored table that batches are merged into by key.

The rows lie in hash buckets of their key, a folder each. A merge reads the buckets that its batch meets,
writes them anew beside the old ones, and then writes a manifest that names the folder of every bucket.
Readers go by the newest manifest, a single file, so they see a merge as a whole or not at all, and a run
that dies leaves folders that nothing refers to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.lineage import delete_folder
from tallyhouse.sources.incremental import latest_per_key, merge_rows

BUCKET = "_bucket"
_MANIFEST = f"{BUCKET} INT, folder STRING"


@dataclass(frozen=True)
class MergedTable:
    """``buckets`` is fixed with the first merge; a bucket should be what one task reads well.

    One writer at a time: a manifest is never replaced, so the second of two that start from the same version
    fails. The driver holds the list of buckets.
    """

    spark: SparkSession
    root: str
    key: str
    cursor: str
    buckets: int = 64

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """Number of the newest manifest, -1 before the first merge."""
        try:
            return self.spark.read.parquet(f"{self.root}/_manifests").agg(F.max("version")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return -1
            raise

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of every bucket that has rows."""
        version = self.version() if version is None else version
        if version < 0:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifests/version={version}").collect()
        return {row[BUCKET]: row["folder"] for row in rows}

    def read(self) -> DataFrame:
        """All rows; those of one version, whatever is merged meanwhile."""
        return self._read(self.folders().values())

    def _read(self, folders) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{folder}" for folder in folders])

    def find(self, key: object) -> DataFrame:
        """The row of one key, from its bucket."""
        folders, everything = self.folders(), self.read()
        wanted = F.lit(key).cast(everything.schema[self.key].dataType)
        bucket = self.spark.range(1).select(self.bucket_of(wanted)).first()[0]
        rows = self._read([folders[bucket]]) if bucket in folders else everything
        return rows.filter(F.col(self.key) == wanted)

    def merge(self, batch: DataFrame) -> list[int]:
        """Merge a batch and return the buckets it met; the larger cursor wins, ties go to the batch.

        A batch may hold several versions of a key. Merging it again changes no row.
        """
        version = self.version()
        folders = self.folders(version)
        data, incoming = f"data/version={version + 1}", f"{self.root}/_incoming/version={version + 1}"
        reduced = latest_per_key(batch, self.key, self.cursor)
        reduced.withColumn(BUCKET, self.bucket_of(F.col(self.key))).write.mode("overwrite").parquet(incoming)
        new = self.spark.read.parquet(incoming)
        met = sorted(row[0] for row in new.select(BUCKET).distinct().collect())
        if met:
            new = new.drop(BUCKET)
            old = [folders[b] for b in met if b in folders]
            rows = merge_rows(self._read(old), new, self.key, self.cursor) if old else new
            rows.withColumn(BUCKET, self.bucket_of(F.col(self.key))).hint("rebalance", F.col(BUCKET)) \
                .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{data}")
            folders |= {b: f"{data}/{BUCKET}={b}" for b in met}
            self.spark.createDataFrame(sorted(folders.items()), _MANIFEST).coalesce(1).write.parquet(
                f"{self.root}/_manifests/version={version + 1}")
        delete_folder(self.spark, incoming)
        return met

    def vacuum(self) -> None:
        """Delete the folders of buckets that only older versions refer to; nobody may read those any more."""
        version = self.version()
        current = set(self.folders(version).values())
        old = {folder for v in range(version) for folder in self.folders(v).values()}
        for folder in old - current:
            delete_folder(self.spark, f"{self.root}/{folder}")
