"""Ranked search for every item of a benchmark over all documents, by Block-Max MaxScore.

Documents are indexed where they are read: a shard holds the documents of one task, or of a part of it, and
for each term that an item asks for the list of its documents, in blocks of numbers packed to few bytes. A
block carries the pairs of frequency and document length that no other pair of the block outdoes, so the
exact largest score of the block is known once the corpus has been counted. Numbers of documents, terms and
documents per term are sums over the shards.

A search runs over the documents of a shard window by window. Lists are sorted by the largest score they can
add; those that together cannot lift a document into the best so far are not essential, and only documents
of the other lists are candidates. Lists that are not essential are met from the largest down: a candidate
that the maximum of its block cannot lift is rejected, and only blocks with candidates left are unpacked. The
best of all shards are merged per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.text import LOWER, Block, as_block, blocks, give_back, prefix_hash, span_hash, stored

TOP = 50
BLOCK_CHARACTERS = 4_000_000
SHARD_DOCUMENTS = 1 << 16
SHARD_POSTINGS = 1 << 22
POSTINGS = 128
WINDOW = 8192
_NO_ID = (1 << 63) - 1
# Bytes of terms: ASCII letters and digits, and all that is not ASCII.
_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def find_terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every term of a block, A-Z lowered."""
    data = LOWER[block.data]
    inside = np.concatenate([[False], _INSIDE[data], [False]])
    # A term also ends where its document does.
    cuts = block.offsets[1:-1]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]])
    starts = np.sort(np.concatenate([np.flatnonzero(inside[1:] & ~inside[:-1]), cuts]))
    ends = np.sort(np.concatenate([np.flatnonzero(~inside[1:] & inside[:-1]), cuts]))
    return span_hash(prefix_hash(data), starts, ends), block.doc_of(starts)


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Corpus:
    """Documents with a term, all their terms, and documents per wanted term."""

    documents: int
    terms: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1))) for df in self.df.tolist()],
                        np.int64)

    def length_factor(self, n: np.ndarray) -> np.ndarray:
        return 50 + (50 * n.astype(np.int64) * self.documents) // max(1, self.terms)


def _pack(values: np.ndarray, list_of: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists, each list in as few bytes a value as its largest needs: bytes, offsets, widths."""
    most = np.maximum.reduceat(values, begin)
    width = np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))
    sizes = np.diff(np.append(begin, len(values)))
    offset = np.concatenate([[0], np.cumsum(sizes * width)])
    out, raw = np.zeros(offset[-1], np.uint8), values.astype("<u4").view(np.uint8).reshape(-1, 4)
    for w in (1, 2, 4):
        of = np.flatnonzero(width[list_of] == w)
        place = offset[list_of[of]] + (of - begin[list_of[of]]) * w
        out[place[:, None] + np.arange(w)] = raw[of, :w]
    return out, offset[:-1], width


# What a shard keeps, all as packed arrays of these types.
_PARTS = {
    "ids": np.int64, "lengths": np.int32, "begin": np.int64, "doc_offset": np.int64, "doc_width": np.int8,
    "tf_offset": np.int64, "tf_width": np.int8, "first_block": np.int64, "last": np.int32, "front_begin": np.int64,
    "front_tf": np.int32, "front_n": np.int32, "doc_bytes": np.uint8, "tf_bytes": np.uint8,
}


def pack_shard(ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> dict:
    """The inverted lists of a shard; postings come in any order, one per term and document."""
    order = np.lexsort((doc, term))
    term, doc, tf = term[order].astype(np.int64), doc[order].astype(np.int64), tf[order].astype(np.int64)
    out = dict.fromkeys(_PARTS, np.zeros(0, np.int64)) | {"ids": ids, "lengths": lengths}
    if not len(term):
        return out | {"terms": term, "dfs": term}
    begin = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    sizes = np.diff(np.append(begin, len(term)))
    list_of = np.repeat(np.arange(len(begin)), sizes)
    gap = np.diff(doc, prepend=0)
    gap[begin] = doc[begin]
    doc_bytes, doc_offset, doc_width = _pack(gap, list_of, begin)
    tf_bytes, tf_offset, tf_width = _pack(tf, list_of, begin)
    new_block = (np.arange(len(term)) - begin[list_of]) % POSTINGS == 0
    block, at = np.cumsum(new_block) - 1, np.flatnonzero(new_block)
    n = lengths[doc].astype(np.int64)
    # From the shortest document of a block on, a pair counts that has a larger frequency than all before.
    order = np.lexsort((-tf, n, block))
    level = np.maximum.accumulate((block[order] << 32) + tf[order])
    front = np.append(True, level[1:] > level[:-1])
    kept = order[front]
    return out | {
        "terms": term[begin], "dfs": sizes, "begin": np.append(begin, len(term)), "doc_offset": doc_offset,
        "doc_width": doc_width, "tf_offset": tf_offset, "tf_width": tf_width,
        "first_block": np.append(block[begin], block[-1] + 1), "last": doc[np.append(at[1:], len(doc)) - 1],
        "front_begin": np.searchsorted(block[kept], np.arange(len(at))), "front_tf": tf[kept], "front_n": n[kept],
        "doc_bytes": doc_bytes, "tf_bytes": tf_bytes}


@dataclass
class _Open:
    """A shard that is being filled."""

    ids: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    postings: list = field(default_factory=list)
    documents: int = 0
    size: int = 0

    def add(self, ids: np.ndarray, block: Block, wanted: np.ndarray) -> None:
        hashes, doc = find_terms(block)
        place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
        hit = wanted[place] == hashes
        key, tf = np.unique(doc[hit] * len(wanted) + place[hit], return_counts=True)
        self.ids.append(ids)
        self.lengths.append(np.bincount(doc, minlength=len(block)))
        self.postings.append((key % len(wanted), key // len(wanted) + self.documents, tf))
        self.documents += len(block)
        self.size += len(key)

    def row(self) -> pa.RecordBatch:
        lengths = np.concatenate(self.lengths)
        shard = pack_shard(np.concatenate(self.ids), lengths, *(np.concatenate(p) for p in zip(*self.postings)))
        packed = {name: pa.array([np.asarray(shard[name]).astype(kind).tobytes()], pa.binary())
                  for name, kind in _PARTS.items()}
        return pa.RecordBatch.from_pydict({
            "documents": pa.array([int((lengths > 0).sum())]), "tokens": pa.array([int(lengths.sum())]),
            "terms": pa.array([shard["terms"].tolist()], pa.list_(pa.int64())),
            "dfs": pa.array([shard["dfs"].tolist()], pa.list_(pa.int64())), **packed})


def build_shards(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """One row per shard over the columns ``id`` and ``text``; ``wanted`` are sorted hashes of terms."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        shard = _Open()
        for rows, block in blocks(batches, "text"):
            shard.add(rows.column(0).fill_null(_NO_ID).to_numpy(), block, held.value)
            if shard.documents >= SHARD_DOCUMENTS or shard.size >= SHARD_POSTINGS:
                yield shard.row()
                shard = _Open()
        if shard.documents:
            yield shard.row()
        give_back()

    schema = "documents bigint, tokens bigint, terms array<bigint>, dfs array<bigint>, "
    return docs.mapInArrow(run, schema + ", ".join(f"{name} binary" for name in _PARTS))


def count_corpus(shards: DataFrame, n_terms: int) -> Corpus:
    """Sums over all shards. To the driver come two numbers and one per wanted term."""
    documents, tokens = shards.agg(F.sum("documents"), F.sum("tokens")).first()
    df = np.zeros(n_terms, np.int64)
    pairs = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p")).select("p.terms", "p.dfs")
    for row in pairs.groupBy("terms").agg(F.sum("dfs").alias("df")).collect():
        df[row.terms] = row.df
    return Corpus(documents or 0, tokens or 0, df)


class Shard:
    """A shard ready to be searched, with the largest scores of its lists and blocks before weighting."""

    def __init__(self, parts: dict, terms: np.ndarray, corpus: Corpus):
        self.__dict__.update(parts)
        self.list_of = {int(t): k for k, t in enumerate(terms)}
        self.m = corpus.length_factor(self.lengths)
        front = _impact(self.front_tf.astype(np.int64), corpus.length_factor(self.front_n))
        self.block_most = np.maximum.reduceat(front, self.front_begin) if len(front) else front
        self.list_most = np.maximum.reduceat(self.block_most, self.first_block[:-1]) if len(front) else front

    def blocks_of(self, k: int) -> slice:
        return slice(self.first_block[k], self.first_block[k + 1])

    def unpack(self, k: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and unweighted scores of some blocks of a list."""
        size = self.begin[k + 1] - self.begin[k]
        at = which[:, None] * POSTINGS + np.arange(POSTINGS)
        there = at < size
        at = np.minimum(at, size - 1)
        gaps = self._values(self.doc_bytes, self.doc_offset[k], self.doc_width[k], size)[at].astype(np.int64)
        last = self.last[self.blocks_of(k)]
        before = np.where(which > 0, last[which - 1], 0)
        doc = (before[:, None] + np.cumsum(gaps, axis=1))[there]
        tf = self._values(self.tf_bytes, self.tf_offset[k], self.tf_width[k], size)[at][there].astype(np.int64)
        return doc, _impact(tf, self.m[doc])

    @staticmethod
    def _values(data: np.ndarray, offset: int, width: int, size: int) -> np.ndarray:
        return data[offset:offset + size * width].view(f"<u{width}")

    def search(self, query: list[tuple[int, int]], top: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``top`` best documents for terms with their weights."""
        lists = sorted((int(w * self.list_most[k]), k, w) for t, w in query if w > 0 and (k := self.list_of.get(t)) is not None)
        bounds = [0]
        for bound, _, _ in lists:
            bounds.append(bounds[-1] + bound)
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = 1
        for low in range(0, len(self.ids), window):
            high = min(low + window, len(self.ids))
            # Lists before the first essential one cannot lift a document to ``least`` together.
            essential = next((e for e in range(len(lists)) if bounds[e + 1] >= least), len(lists))
            score = np.zeros(high - low, np.int64)
            for _, k, weight in lists[essential:]:
                last = self.last[self.blocks_of(k)]
                a, b = np.searchsorted(last, [low, high - 1])
                if a == len(last):
                    continue
                doc, impact = self.unpack(k, np.arange(a, min(b + 1, len(last))))
                inside = (doc >= low) & (doc < high)
                score[doc[inside] - low] += weight * impact[inside]
            found = np.flatnonzero(score)
            found = found[score[found] + bounds[essential] >= least]
            for e in range(essential - 1, -1, -1):
                if not len(found):
                    break
                _, k, weight = lists[e]
                last, most = self.last[self.blocks_of(k)], self.block_most[self.blocks_of(k)]
                block = np.searchsorted(last, found + low)
                listed = block < len(last)
                block_bound = np.where(listed, weight * most[np.minimum(block, len(last) - 1)], 0)
                lifted = score[found] + block_bound + bounds[e] >= least
                found, block = found[lifted], block[lifted]
                which = np.unique(block[listed[lifted]])
                if len(which):
                    doc, impact = self.unpack(k, which)
                    place = np.minimum(np.searchsorted(doc, found + low), len(doc) - 1)
                    same = doc[place] == found + low
                    score[found[same]] += weight * impact[place[same]]
                found = found[score[found] + bounds[e] >= least]
            if len(found):
                best = np.concatenate([best, score[found]])
                best_id = np.concatenate([best_id, self.ids[low + found]])
                order = np.lexsort((best_id, -best))[:top]
                best, best_id = best[order], best_id[order]
                if len(best) == top:
                    least = max(1, int(best[-1]))
        return best_id, best


def _read_shards(batches, corpus: Corpus) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            parts = {name: np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in _PARTS.items()}
            yield Shard(parts, np.array(batch.column("terms")[i].as_py(), np.int64), corpus)


def _item_blocks(items: DataFrame, item_column: str, text_column: str) -> Iterator[list[tuple]]:
    """The distinct items with a text, in blocks of a bounded number of characters."""
    rows = items.select(F.col(f"`{item_column}`").alias("item"), F.col(f"`{text_column}`").alias("text")) \
        .filter("text is not null").distinct()
    size = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-size // BLOCK_CHARACTERS)
    for k in range(n):
        yield [(r.item, r.text) for r in
               rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).orderBy("item", "text").collect()]


def rank_documents(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   item_column: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every item: its id, ``rank``, the document's id and ``score``.

    Ids of documents are whole numbers. Every row of ``docs`` is a document, also where rows or ids repeat;
    one with a null id comes after others of its score. Null, empty and termless texts match nothing. Distinct
    rows of items are ranked each on its own, also under a shared or null id; an item without terms, or an
    empty table on either side, gives no rows. Other columns are left out, whatever their names.

    Terms are told apart by 64-bit hashes. Items are held in blocks of ``BLOCK_CHARACTERS``; each further block
    is another pass over the documents.
    """
    spark = docs.sparkSession
    item_type, id_type = items.schema[item_column].dataType.simpleString(), docs.schema[id_column].dataType
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    found = spark.createDataFrame([], f"item {item_type}, number int, block int, id bigint, score bigint")

    def search(held, block):
        def run(batches):
            corpus, weights, queries, ids = held.value
            for shard in _read_shards(batches, corpus):
                for number, terms in enumerate(queries):
                    documents, scores = shard.search([(t, int(weights[t])) for t in terms], top)
                    if len(documents):
                        n = len(documents)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[number]] * n, ids.type), pa.array(np.full(n, number, np.int32)),
                             pa.array(np.full(n, block, np.int32)), pa.array(documents), pa.array(scores)],
                            ["item", "number", "block", "id", "score"])
            give_back()
        return run

    for k, rows in enumerate(_item_blocks(items, item_column, item_text)):
        hashes, item_of = find_terms(as_block(pa.array([text for _, text in rows], pa.string())))
        wanted, term = np.unique(hashes, return_inverse=True)
        if not len(wanted):
            continue
        queries = [np.unique(term[item_of == i]).tolist() for i in range(len(rows))]
        shards = stored(build_shards(texts, wanted), "search-shards")
        corpus = count_corpus(shards, len(wanted))
        ids = pa.array([item for item, _ in rows], {"bigint": pa.int64(), "int": pa.int32()}.get(item_type))
        held = spark.sparkContext.broadcast((corpus, corpus.weights(), queries, ids))
        found = found.unionByName(shards.drop("documents", "tokens", "dfs").mapInArrow(search(held, k), found.schema))

    place = W.partitionBy("block", "number").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top).select(
        F.col("item").alias(item_column), "rank",
        F.when(F.col("id") != _NO_ID, F.col("id")).cast(id_type).alias(id_column), "score")
