"""A set of ids of fixed size that may hold more than it should, to pass over rows before a shuffle.

It never decides anything: what it lets through is joined exactly. With very many ids it lets everything
through, and the join does all the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import mix

FILTER_BITS = 23
# Bits in a bitmap of Spark's.
_PART = 1 << 15


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits for every id of a one-column frame; a null counts as 0.

    Tasks set the bits of their ids in bitmaps of ``_PART`` bits each, which are joined part by part."""
    def place(batches):
        for batch in batches:
            slot = np.unique(_slot(batch.column(0).fill_null(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array((slot // _PART).astype(np.int32)), pa.array(slot % _PART)],
                                             ["part", "bit"])

    out = np.zeros((1 << FILTER_BITS) // _PART * (_PART >> 3), np.uint8).reshape(-1, _PART >> 3)
    bitmaps = ids.mapInArrow(place, "part int, bit bigint").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    for row in bitmaps.collect():
        out[row.part] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def may_hold(bits: np.ndarray, ids: pa.Array) -> np.ndarray:
    slot = _slot(ids.fill_null(0).to_numpy())
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
