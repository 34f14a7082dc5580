"""Cursor-based extraction, change capture and key-based merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETED = "_deleted"


def high_water_mark(df: DataFrame, cursor: str) -> DataFrame:
    """One row with the largest cursor value seen."""
    return df.agg(F.max(cursor).alias("high_water_mark"))


def extract_since(df: DataFrame, cursor: str, mark: Column | object | None,
                  overlap: object | None = None) -> DataFrame:
    """Rows whose cursor is strictly greater than the mark; every row when there is no mark yet.

    ``overlap`` moves the mark back (a timedelta for times, a number for numbers), so that rows which
    arrive that late are picked up as well; ``upsert`` makes reading the others again harmless. Rows
    without a cursor value are always read, since nothing tells whether they are new.
    """
    if mark is None:
        return df
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    if overlap is not None:
        mark = mark - F.lit(overlap)
    return df.filter((F.col(cursor) > mark) | F.col(cursor).isNull())


def _row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.struct(F.col(c), F.col(c).isNull()) for c in sorted(columns)])


def changed_rows(snapshot: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of a snapshot whose key is not known or whose values differ from the known row of that key.

    For tables without a cursor that moves when a row changes. Rows are compared as a whole by hash, so
    one shuffle of keys and hashes on each side decides.
    """
    mark = _row_hash(snapshot.columns).alias("_mark")
    seen = known.select(F.col(key).alias("_key"), mark.alias("_seen"))
    marked = snapshot.withColumn("_mark", mark)
    same = marked[key].eqNullSafe(seen["_key"]) & (marked["_mark"] == seen["_seen"])
    return marked.join(seen, same, "left_anti").drop("_mark")


def snapshot_changes(snapshot: DataFrame, known: DataFrame, key: str, cursor: str) -> DataFrame:
    """``changed_rows``, and a tombstone for every known key that the snapshot lacks.

    The column ``_deleted`` tells the two apart. A tombstone has its key and the cursor value of the known
    row; other columns are null. One full join finds both, and only keys, hashes and cursors of the known
    rows take part in it. Both sides have unique keys; a null key is one like any other.
    """
    columns = snapshot.columns
    now = snapshot.select(F.col(key).alias("_key"), _row_hash(columns).alias("_mark"), F.struct(*columns).alias("_row"))
    seen = known.select(F.col(key).alias("_known"), _row_hash(columns).alias("_seen"), F.col(cursor).alias("_at"))
    gone = F.col("_mark").isNull()
    kept = {cursor: F.col("_at"), key: F.col("_known")}
    return now.join(seen, F.col("_key").eqNullSafe(F.col("_known")), "full").filter(
        gone | F.col("_seen").isNull() | (F.col("_mark") != F.col("_seen"))
    ).select(*[F.when(gone, kept.get(c)).otherwise(F.col(f"_row.{c}")).alias(c) for c in columns], gone.alias(DELETED))


def missing_keys(known: DataFrame, present: DataFrame, key: str, cursor: str) -> DataFrame:
    """Tombstones for known rows whose key is not present any more; only that column of ``present`` is read."""
    there = present.select(F.col(key).alias("_key"))
    gone = known.join(there, known[key].eqNullSafe(F.col("_key")), "left_anti")
    return gone.select(*[F.col(c) if c in (key, cursor) else F.lit(None).cast(t).alias(c)
                         for c, t in known.dtypes], F.lit(True).alias(DELETED))


def latest_per_key(df: DataFrame, key: str, *cursor: str, within: tuple[str, ...] = ()) -> DataFrame:
    """The row with the largest cursor per key; further cursors decide equal ones.

    Written as an aggregate, not a window: versions of one key are reduced before the shuffle, so
    a key that holds a large share of all rows never meets in one task. Equal cursors are decided
    by the remaining columns, which makes the result independent of row order. ``within`` names columns
    whose values are told apart as well. Every column is shuffled once, and the rows leave by ``key``, so that
    an aggregate by it needs no further shuffle.
    """
    keys = (key, *within)
    first = [c for c in dict.fromkeys(cursor) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    newest = F.max(F.struct(*[F.col(c) for c in (*first, *rest)] or [F.lit(True)]))
    return df.groupBy(*keys).agg(newest.alias("_newest")).select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in df.columns])


def merge_rows(target: DataFrame, batch: DataFrame, key: str, cursor: str) -> DataFrame:
    """Target and batch, each unique by key, as one; the larger cursor wins, ties go to the batch.

    One full join reads either side once.
    """
    columns = target.columns
    old = target.select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
    new = batch.select(F.col(key).alias("_batch_key"), F.struct(*columns).alias("_new"))
    at, before = F.col(f"_new.{cursor}"), F.col(f"_old.{cursor}")
    wins = F.col("_old").isNull() | (F.col("_new").isNotNull() & (before.isNull() | (at >= before)))
    joined = old.join(new, F.col("_key").eqNullSafe(F.col("_batch_key")), "full")
    return joined.select(F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def upsert(target: DataFrame, updates: DataFrame, key: str, cursor: str) -> DataFrame:
    """Merge updates into a target that is unique by key; the larger cursor wins, ties go to the update.

    Replaying a batch changes nothing, also for a NULL key, which is a key like any other. Only the update
    side is reduced first. Both sides are read once and shuffled by key; where the target is large and stored,
    ``MergedTable`` reads and writes only the buckets that a batch meets. A target that may hold duplicates
    goes through ``latest_per_key`` first.
    """
    return merge_rows(target, latest_per_key(updates.select(*target.columns), key, cursor), key, cursor)
