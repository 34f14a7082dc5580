"""Whole texts as byte arrays, and vectorised hashes over them.

A task reads Arrow batches; ``blocks`` cuts them into runs of whole documents whose bytes are handled at
once by numpy. A block holds at least one document and, beyond that, about ``BLOCK_BYTES``, so that
memory depends on the longest text alone and not on the number of rows.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.lineage import scratch_path

BLOCK_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Arrow batches of the session are limited to some megabytes, since a batch stands in
    the memory of the executor and of its Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_crc(column: str) -> Column:
    """crc32 of a number written as text; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


@dataclass
class Block:
    """Documents laid end to end: document ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray
    is_null: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """Index of the document that holds each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Per document, the sum of a value given for each byte."""
        total = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def as_block(column: pa.Array) -> Block:
    """A string column as one block; a null is an empty text that is marked."""
    is_null = column.is_null().to_numpy(zero_copy_only=False)
    column = column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()).cast(pa.large_binary())
    if is_null.any():
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return Block(data[offsets[0]:offsets[-1]], offsets - offsets[0], is_null)


def blocks(batches, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Slices of the batches with the bytes of their text column. At the end, unused memory goes back."""
    try:
        yield from _blocks(batches, text, block_bytes)
    finally:
        give_back()


def give_back() -> None:
    """Return freed memory to the system; a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _blocks(batches, text: str, block_bytes: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = as_block(batch.column(batch.schema.get_field_index(text)))
        cuts, first = [0], 0
        for i in range(1, len(whole)):
            if whole.offsets[i + 1] - whole.offsets[first] > block_bytes:
                cuts.append(i)
                first = i
        cuts.append(len(whole))
        for a, b in zip(cuts, cuts[1:]):
            base, end = whole.offsets[a], whole.offsets[b]
            yield batch.slice(a, b - a), Block(whole.data[base:end], whole.offsets[a:b + 1] - base, whole.is_null[a:b])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_BASE)
    return x ^ (x >> np.uint64(32))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base of the polynomial hash modulo 2^64, or of its inverse."""
    held = _powers.get(inverse)
    if held is None or len(held) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        if n <= 8 * BLOCK_BYTES:
            _powers[inverse] = held
    return held[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: entry ``i`` covers the first ``i`` bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever they stand."""
    inverse = powers(len(prefix), inverse=True)
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hash(values: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` values from each position on, built by doubling."""
    size, out, done = 1, None, 0
    current = values.astype(np.uint64) + np.uint64(1)
    power = powers(q + 1)
    while True:
        if q & size:
            if out is None:
                out = current
            else:
                n = max(0, len(values) - size - done + 1)
                out = current[:n] * power[done] + out[size:size + n]
            done += size
        if size * 2 > q:
            break
        n = max(0, len(current) - size)
        current = current[:n] * power[size] + current[size:size + n]
        size *= 2
    return mix(out[:max(0, len(values) - q + 1)])


@dataclass
class Words:
    """Words of a block: byte spans, the document of each, and where each document's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def find_words(block: Block) -> Words:
    """Maximal runs of bytes that are no ASCII white space, within each document."""
    inside = ~SPACE[block.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[:-1] = inside
    edge[1:-1] &= ~inside[:-1]
    begins = block.offsets[:-1][block.lengths > 0]
    edge[begins] = inside[begins]
    starts = np.flatnonzero(edge[:-1])
    stop = np.zeros(len(inside) + 1, bool)
    stop[1:] = inside
    stop[1:-1] &= ~inside[1:]
    finishes = block.offsets[1:][block.lengths > 0]
    stop[finishes] = inside[finishes - 1]
    ends = np.flatnonzero(stop)
    doc = block.doc_of(starts)
    return Words(starts, ends, doc, np.searchsorted(doc, np.arange(len(block) + 1)))


def window_hashes(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words that lies in one document, and the run's first word."""
    n = max(0, len(hashes) - size + 1)
    first = np.flatnonzero(doc[:n] == doc[size - 1:size - 1 + n])
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + hashes[first + k]
    return mix(out), first


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read from there; lost executors don't undo it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
