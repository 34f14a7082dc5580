"""Near duplicates by fingerprints of word shingles, compared exactly in tiles.

A fingerprint has a bit set where most of the document's shingles have it in their hash. Distinct
fingerprints are laid out in cells, and a cell is cut into tiles in the order of population counts. The
counts of two fingerprints differ by at most as many as their bits do, so tile pairs whose counts lie
further apart than the radius are skipped; the others are compared by exclusive-or and bit counts.

Comparing all tiles with each other would be quadratic in the corpus. Two fingerprints that differ in at
most three bits agree in one whole quarter of their bits, so each fingerprint stands in four cells, one
for the leading bits of each quarter, and only tiles of the same cell meet. No link is lost by that. The
number of leading bits follows the number of fingerprints, so cells keep their size as the corpus grows.
A cell that is large all the same is cut into chunks, and pairs of chunks are dealt to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import connected_components
from tallyhouse.llm.rows import sorted_groups
from tallyhouse.llm.text import LOWER, SPACE, Block, blocks, find_words, stored

WORDS = 3
RADIUS = 3
SEED = 42
CELL = 4096
CHUNK = 1 << 16
TILE = 512
_RUN = 255
# Bits of a byte as one byte each.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def shingle_spans(block: Block, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with A-Z lowered and one space between words, and begin, end and document of each shingle.

    A document with fewer words than ``size`` has one shingle of all of them, one without words none.
    """
    words = find_words(block)
    keep = ~SPACE[block.data]
    keep[words.ends[words.ends < block.offsets[words.doc + 1]]] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    plain = LOWER[block.data[keep]]
    plain[SPACE[plain]] = 32
    n = np.diff(words.first)
    shingles = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(block)), shingles)
    first = words.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(first + size, words.first[1:][doc]) - 1
    return plain.tobytes(), place[words.starts[first]], place[words.ends[last]], doc


def bit_counts(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """For each run of hashes (given by where it begins) how many have each of the 64 bits.

    Eight counters share a word, so a run is added up in pieces that no counter overflows in.
    """
    sizes = np.diff(np.append(runs, len(hashes)))
    pieces = -(-sizes // _RUN)
    first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    spread = _SPREAD[hashes.view(np.uint8)].reshape(-1, 8)
    partial = np.add.reduceat(spread, np.repeat(runs, pieces) + within * _RUN, axis=0)
    return np.add.reduceat(partial.view(np.uint8).reshape(-1, 64).astype(np.int64), first, axis=0)


def fingerprints(block: Block, size: int = WORDS, seed: int = SEED) -> np.ndarray:
    """One fingerprint per document; 0 for one without words."""
    text, begin, end, doc = shingle_spans(block, size)
    out = np.zeros(len(block), np.uint64)
    if len(doc):
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(text[a:b], seed) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(doc))
        runs = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        most = 2 * bit_counts(hashes, runs) > np.diff(np.append(runs, len(doc)))[:, None]
        out[doc[runs]] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def tile_pairs(count: np.ndarray, tile: int, radius: int) -> Iterator[tuple[slice, slice]]:
    """Pairs of tiles of a list that is sorted by population count, without those too far apart."""
    starts = range(0, len(count), tile)
    for a in starts:
        reach = count[min(a + tile, len(count)) - 1] + radius
        for b in range(a, len(count), tile):
            if count[b] > reach:
                break
            yield slice(a, a + tile), slice(b, b + tile)


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Note links between the members ``a`` and ``b``: ``root`` names the smallest member of each component."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := root[root], root):
            root[:] = up


def link_tiles(values: np.ndarray, chunk: np.ndarray, radius: int = RADIUS, tile: int = TILE) -> np.ndarray:
    """For each fingerprint the position of a representative of all that links reach from it.

    Where the values are of two chunks, only links between the chunks count.
    """
    count = np.bitwise_count(values).astype(np.int64)
    order = np.argsort(count, kind="stable")
    values, chunk, count = values[order], chunk[order], count[order]
    two, root = len(chunk) > 0 and (chunk != chunk[0]).any(), np.arange(len(values))
    for a, b in tile_pairs(count, tile, radius):
        near = np.bitwise_count(values[a, None] ^ values[None, b]) <= radius
        if two:
            near &= chunk[a, None] != chunk[None, b]
        x, y = np.nonzero(near)
        _join(root, x + a.start, y + b.start)
    out = np.empty(len(order), np.int64)
    out[order] = order[root]
    return out


def _cells(distinct: DataFrame, cell: int, chunk: int) -> DataFrame:
    """Fingerprints by ``cell`` and pair of chunks ``i``, ``j``; ``own`` is the chunk that a row belongs to."""
    bits = min(16, max(0, (distinct.count() // cell).bit_length()))
    quarter = F.posexplode(F.array(*[F.shiftrightunsigned("fp", 64 - 16 * q - bits).bitwiseAND((1 << bits) - 1)
                                     for q in range(4)])).alias("quarter", "lead")
    placed = distinct.select("fp", quarter).select((F.col("quarter") * (1 << 16) + F.col("lead")).alias("cell"), "fp")
    large = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")).filter("chunks > 1")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    split = placed.join(large, "cell", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).select(
        "cell", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    return split.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")


def links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints (column ``fp``) that connect what lies within the radius.

    Not every close pair is a row: a pair of chunks gives each fingerprint one link at most, to a
    representative of those it reaches there.
    """
    if not 0 <= radius <= 3:
        raise ValueError("cells are made for a radius of 3 at most")

    def run(batches):
        for group in sorted_groups(batches, 3):
            fp = group.column("fp").to_numpy()
            root = link_tiles(fp.view(np.uint64), group.column("own").to_numpy(), radius)
            linked = root != np.arange(len(root))
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], ["a", "b"])

    return _cells(distinct, cell, chunk).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "fp") \
        .mapInArrow(run, "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS,
                       radius: int = RADIUS, seed: int = SEED, cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Ids are whole numbers. Null, empty and wordless texts have the fingerprint 0 and are linked like any
    other. The component is named by its smallest id; a document with a null id counts for the links of
    others, and a component of such documents alone has no name. Equal rows come back as often as they are
    given; other columns are left out, whatever their names. An empty table gives no rows.
    """
    def run(batches):
        for rows, block in blocks(batches, "text"):
            found = fingerprints(block, words, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found)], ["id", "fp"])

    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    documents = stored(texts.mapInArrow(run, "id bigint, fp bigint"), "fingerprints")
    distinct = stored(documents.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints-distinct")
    roots = connected_components(stored(links(distinct.select("fp"), radius, cell, chunk), "fingerprint-links"))
    rooted = stored(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Stored, so that the join by fingerprint is one that Spark can split where a text has very many copies.
    named = stored(rooted.join(names, "root").select("fp", "component_id"), "fingerprint-names")
    return documents.join(named, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
