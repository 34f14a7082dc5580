"""Token counts from an exact histogram of encoded lengths.

Documents are reduced to one row per distinct length, with map-side sums; suffix sums over that histogram
then answer, for every length taken as a context limit, how many documents are at least as long, how many
ids a cut at the limit keeps, and which quantile the length is. The suffix sums run within blocks of lengths
and over the totals of blocks, so no task meets more than a block of lengths or the list of blocks.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text import blocks, stored
from tallyhouse.llm.token_files import load_file_encoder

LENGTHS_PER_BLOCK = 64


def encoded_lengths(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and the number of ids of its whole text, without special tokens.

    A null or empty text has none. Repeated rows and shared or null ids stay as they are, other columns are
    left out, whatever their names, and an empty table gives no rows.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        encoder = load_file_encoder(path)
        for rows, _ in blocks(batches, "text"):
            counts = [len(encoder.encode(t or "")) // 4 for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts, pa.int64())], ["id", "n_tokens"])

    return docs.selectExpr(f"`{id_column}` as id", f"`{text_column}` as text") \
        .mapInArrow(run, f"id {id_type}, n_tokens bigint").withColumnRenamed("id", id_column)


def length_histogram(lengths: DataFrame, length_column: str = "n_tokens") -> DataFrame:
    """One row per distinct length that occurs; rows with a null length are left out.

    ``n_docs`` have the length, ``docs_at_least`` it or more, ``tokens_at_least`` is the number of ids of
    those, ``kept_tokens`` what is left of all documents cut to the length, ``cut_docs`` those that lose
    something, ``quantile`` the share of documents of at most this length. An empty table gives no row.

    The counts, one row per length, are stored once, so the lengths are worked out only once.
    """
    counts = stored(
        lengths.select(F.col(f"`{length_column}`").cast("bigint").alias("n_tokens")).dropna()
        .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "length-counts",
    ).withColumn("block", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK))
    totals = counts.groupBy("block").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "block", F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("docs").over(every).alias("all_docs"), F.sum("tokens").over(every).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    return (
        counts.join(totals, "block")
        .withColumn("docs_at_least", F.col("docs_above") + F.sum("n_docs").over(inside))
        .withColumn("tokens_at_least", F.col("tokens_above") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside))
        .withColumn("docs_longer", F.col("docs_at_least") - F.col("n_docs"))
        .select(
            "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
            (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"))
            .alias("kept_tokens"),
            F.col("docs_longer").alias("cut_docs"),
            ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"))
    )


def at_limit(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents and ids in all, documents cut and ids kept.

    Only the histogram is read, once for all limits; an empty one gives no row.
    """
    size, limit = F.col("n_tokens"), F.col("limit")
    every = F.explode(F.array([F.lit(int(x)).cast("bigint") for x in limits])).alias("limit")
    return histogram.select(every, size, "n_docs").groupBy("limit").agg(
        F.sum("n_docs").alias("n_docs"), F.sum(size * F.col("n_docs")).alias("n_tokens"),
        F.sum(F.when(size > limit, F.col("n_docs")).otherwise(0)).alias("cut_docs"),
        F.sum(F.least(size, limit) * F.col("n_docs")).alias("kept_tokens"))


def quantile(histogram: DataFrame, share: float) -> int | None:
    """The smallest length such that at least ``share`` of the documents are no longer; None without any."""
    return histogram.filter(F.col("quantile") >= share).agg(F.min("n_tokens")).first()[0]
