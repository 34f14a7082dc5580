"""Benchmark passages in documents, found by the q-gram lemma and banded alignment.

Texts are compared as characters with A-Z taken as a-z and every run of white space as one space. A passage
of ``m`` characters that stands in a document with at most ``k`` edits shares at least ``m - q + 1 - k * q``
q-grams with it, and the places of those lie on diagonals (place in the document less place in the passage)
that differ by ``k`` at most. So the shared q-grams are counted in bands of ``2 * (k + 1)`` diagonals that
overlap by half; one band holds all of an occurrence. Bands that reach the bound are aligned, over the band's
own diagonals widened by ``k`` on both sides, and stay if the edit distance is within ``k``. Bands that meet, as
where a passage repeats one character, are aligned as one. Hits are counted in parts of ``HITS``, so texts and
passages that share very many of them take time and no more memory.

The budget ``k`` is ``edit_rate`` times the passage's length, and less for short passages, so that the bound
is one at least. Passages shorter than ``q`` are found where they stand literally; empty ones nowhere.

The benchmark is the query set. It goes to the tasks in blocks of at most about ``BLOCK_CHARACTERS``, chosen
by a hash of the item, and all documents are read against each block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import Block, blocks, gram_hash

Q = 10
EDIT_RATE = 0.08
BLOCK_CHARACTERS = 4_000_000
HITS = 1 << 20
_FILTER_BITS = 22


def normal_form(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Lower A-Z and white space in place; returns which characters stay, one for each run of space."""
    codes[(codes >= 65) & (codes <= 90)] += 32
    space = (codes <= 13) & (codes >= 9) | (codes == 32) | (codes == 0xA0)
    codes[space] = 32
    stay = np.ones(len(codes), bool)
    stay[1:] = ~(space[1:] & space[:-1] & (doc[1:] == doc[:-1]))
    return stay


def _codes(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32).copy()


def normalise(text: str) -> np.ndarray:
    codes = _codes(text.encode())
    return codes[normal_form(codes, np.zeros(len(codes), np.int8))]


@dataclass
class Passages:
    """Distinct passages with the items that have them, and an index of their q-grams."""

    codes: list[np.ndarray]
    items: list[list[int]]
    q: int
    edit_rate: float

    def __post_init__(self):
        sizes = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.maximum(0, np.minimum((self.edit_rate * sizes).astype(np.int64), (sizes - self.q) // self.q))
        self.bound = sizes - self.q + 1 - self.budget * self.q
        grams = [gram_hash(c, self.q) for c in self.codes]
        hashes = np.concatenate([np.zeros(0, np.uint64), *grams])
        passage = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
        order = np.argsort(hashes, kind="stable")
        self.passage, self.place = passage[order], place[order]
        self.hashes, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.short = [i for i, n in enumerate(sizes) if 0 < n < self.q]

    @classmethod
    def of(cls, items, q: int = Q, edit_rate: float = EDIT_RATE) -> "Passages":
        """From pairs of item id and text; equal passages are looked for once."""
        found: dict[bytes, tuple[np.ndarray, list[int]]] = {}
        for item, text in items:
            codes = normalise(text)
            if len(codes):
                found.setdefault(codes.tobytes(), (codes, []))[1].append(item)
        return cls([c for c, _ in found.values()], [i for _, i in found.values()], q, edit_rate)


_NEVER = np.int64(1 << 40)


def _edits_by_end(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int,
                  free_start: bool) -> np.ndarray:
    """Least edits between the passage and a part of ``text``, for each end that part may have: entry ``i`` is
    for the end ``low + len(passage) + i``, over diagonals ``low`` to ``high``. The part begins anywhere, or
    at 0 if ``free_start`` is false. Gives up where no beginning of the passage is within the budget."""
    width, n = high - low + 1, len(text)
    offsets = np.arange(width)
    ends = low + offsets
    row = np.where((ends >= 0) & (ends <= n), 0 if free_start else ends, _NEVER)
    for i in range(1, len(passage) + 1):
        ends = low + i + offsets
        inside = (ends >= 0) & (ends <= n)
        letters = text[np.clip(ends - 1, 0, n - 1)] if n else np.zeros(width, np.uint32)
        step = row + (letters != passage[i - 1])
        step[(ends < 1) | ~inside] = _NEVER
        skip = np.append(row[1:], _NEVER) + 1
        row = np.where(inside, np.minimum(step, skip), _NEVER)
        row = np.minimum(row, np.minimum.accumulate(row - offsets) + offsets)
        row[~inside] = _NEVER
        if i % 8 == 0 and row.min() > budget:
            return np.full(width, _NEVER)
    return row


def _start(passage: np.ndarray, text: np.ndarray, end: int, edits: int, budget: int) -> int:
    """Where the part begins that has these edits and ends there; of several the one nearest to the end."""
    if edits == 0:
        return end - len(passage)
    # Backwards from the end, as far as the budget lets the part be longer than the passage.
    first = max(0, end - len(passage) - budget)
    back = _edits_by_end(passage[::-1], text[first:end][::-1], -budget, budget, budget, False)
    return end - (len(passage) - budget + int(np.argmin(back)))


def _literal_start(passage: np.ndarray, text: np.ndarray) -> int:
    """Where the passage first stands without an edit, or -1."""
    wanted, whole, at = passage.tobytes(), text.tobytes(), -1
    while (at := whole.find(wanted, at + 1)) >= 0 and at % 4:
        pass
    return at // 4 if at >= 0 else -1


def occurrences(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> list[tuple[int, int, int]]:
    """Edits, start and end of the occurrences with their diagonals within ``budget`` of ``low``..``high``.

    They do not overlap: the one with the fewest edits counts, and of those the one that ends first.
    """
    low, high = low - budget, high + budget
    if high - low < len(passage) - 2 * budget:
        # Two that lie apart do not fit in.
        same = _literal_start(passage, text)
        if same >= 0 and low <= same <= high:
            return [(0, same, same + len(passage))]
    cost = _edits_by_end(passage, text, low, high, budget, True)
    within = np.flatnonzero(cost <= budget)
    ends, cost = low + len(passage) + within, cost[within]
    free, out = np.ones(len(text) + 1, bool), []
    for end, edits in zip(*(x[np.lexsort((ends, cost))].tolist() for x in (ends, cost))):
        # All that ends here holds this much.
        if not free[max(0, end - len(passage) + budget):end].all():
            continue
        start = _start(passage, text, end, edits, budget)
        if free[start:end].all():
            free[start:end] = False
            out.append((edits, start, end))
    return out


def find_in_block(block: Block, wanted: Passages) -> list[tuple[int, int, int, int, int, int]]:
    """(document, passage, edits, start, end, shared q-grams) of the occurrences in a block of documents.

    Places are characters of the document as given. Of occurrences of a passage that overlap, the one with
    the fewest edits counts, and of those the first.
    """
    raw = block.data.tobytes()
    starts_char = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    first = starts_char[block.offsets]
    codes = _codes(raw)
    doc = np.repeat(np.arange(len(block)), np.diff(first))
    stay = normal_form(codes, doc)
    at = np.flatnonzero(stay)
    codes, doc = codes[at], doc[at]
    begin = np.searchsorted(doc, np.arange(len(block) + 1))
    bands = _bands(codes, doc, begin, wanted)
    for p in wanted.short:
        bands += _literal(codes, doc, begin, wanted.codes[p], p)
    found: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for d, p, low, high, shared in bands:
        passage, text, budget = wanted.codes[p], codes[begin[d]:begin[d + 1]], int(wanted.budget[p])
        around = max(0, low - 2 * budget)
        near = text[around:high + len(passage) + 2 * budget + 1]
        for edits, a, b in occurrences(passage, near, low - around, high - around, budget):
            found.setdefault((d, p), []).append((edits, a + around, b + around, shared))
    out = []
    for (d, p), places in found.items():
        base, free = begin[d], np.ones(begin[d + 1] - begin[d] + 1, bool)
        for edits, a, b, shared in sorted(places):
            if free[a:b].all():
                free[a:b] = False
                out.append((d, p, edits, int(at[base + a] - first[d]),
                            int(at[base + b - 1] + 1 - first[d]) if b > a else int(at[base + a] - first[d]), shared))
    return sorted(out)


def _sums(pair: np.ndarray, band: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct bands of pairs, in order, with the sum of ``n``."""
    order = np.lexsort((band, pair))
    pair, band, n = pair[order], band[order], n[order]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (band[1:] != band[:-1]))) if len(pair) else order
    return pair[first], band[first], np.add.reduceat(n, first) if len(pair) else n


def _hits(codes, doc, begin, wanted: Passages):
    """Shared q-grams as (passage, document, diagonal) arrays of some ``HITS`` entries each."""
    hashes = gram_hash(codes, wanted.q)
    if not len(hashes) or not len(wanted.hashes):
        return
    place = np.flatnonzero(wanted.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    which = np.searchsorted(wanted.hashes, hashes[place])
    which[which == len(wanted.hashes)] = 0
    equal = (wanted.hashes[which] == hashes[place]) & (doc[place] == doc[place + wanted.q - 1])
    place, which = place[equal], which[equal]
    many = wanted.first[which + 1] - wanted.first[which]
    upto = np.cumsum(many)
    cuts = np.searchsorted(upto, np.arange(HITS, upto[-1] + HITS, HITS)) + 1 if len(upto) else ()
    for a, b in zip(np.concatenate([[0], cuts[:-1]]).astype(np.int64) if len(cuts) else (), cuts):
        m = many[a:b]
        entry = np.repeat(wanted.first[which[a:b]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        at = np.repeat(place[a:b], m)
        own = doc[at]
        yield wanted.passage[entry], own, at - begin[own] - wanted.place[entry]


def _bands(codes, doc, begin, wanted: Passages):
    """(document, passage, lowest and highest diagonal, shared q-grams) of the bands that reach the bound.

    Bands that meet are one; the number of shared q-grams is the largest of any of them.
    """
    def placed():
        for passage, own, diagonal in _hits(codes, doc, begin, wanted):
            band = diagonal // (wanted.budget[passage] + 1)
            # A hit counts in the band that begins with its step and in the one before.
            pair = passage * np.int64(len(begin)) + own
            pair, band = np.concatenate([pair, pair]), np.concatenate([band, band - 1])
            slot = ((pair * np.int64(0x2545F4914F6CDD1D) + band * np.int64(0x5851F42D4C957F2D)) >> np.int64(44)) \
                & np.int64((1 << 20) - 1)
            yield pair, band, slot

    in_slot = np.zeros(1 << 20, np.int64)
    for *_, slot in placed():
        in_slot += np.bincount(slot, minlength=1 << 20)
    empty = np.zeros(0, np.int64)
    counted = (empty, empty, empty)
    for pair, band, slot in placed():
        near = in_slot[slot] >= wanted.bound[pair // len(begin)]
        part = _sums(pair[near], band[near], np.ones(near.sum(), np.int64))
        counted = tuple(np.concatenate(c) for c in zip(counted, part)) if len(counted[0]) else part
        if len(counted[0]) > 4 * HITS:
            counted = _sums(*counted)
    pair, band, shared = _sums(*counted)
    enough = shared >= wanted.bound[pair // len(begin)]
    pair, band, shared = pair[enough], band[enough], shared[enough]
    if not len(pair):
        return []
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (band[1:] - band[:-1] > 2)))
    passage, own = pair[first] // len(begin), pair[first] % len(begin)
    step, last = wanted.budget[passage] + 1, np.append(first[1:], len(pair)) - 1
    return [(int(d), int(p), int(a * s), int((b + 2) * s - 1), int(n)) for d, p, a, b, s, n in zip(
        own, passage, band[first], band[last], step, np.maximum.reduceat(shared, first))]


def _literal(codes, doc, begin, passage, p):
    """Bands of one diagonal where a passage that is shorter than a q-gram stands."""
    n = max(0, len(codes) - len(passage) + 1)
    hit = np.ones(n, bool)
    for k, code in enumerate(passage):
        hit &= codes[k:k + n] == code
    return [(int(doc[i]), p, int(i - begin[doc[i]]), int(i - begin[doc[i]]), 0)
            for i in np.flatnonzero(hit) if doc[i] == doc[i + len(passage) - 1]]


def _query_blocks(benchmark: DataFrame, item_column: str, text_column: str, q: int, edit_rate: float):
    """The benchmark as passages, block by block."""
    items = benchmark.select(F.col(f"`{item_column}`").alias("item"), F.col(f"`{text_column}`").alias("text")) \
        .filter("text is not null and item is not null").distinct()
    size = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-size // BLOCK_CHARACTERS)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).orderBy("item", "text").collect()
        wanted = Passages.of([(r.item, r.text) for r in rows], q, edit_rate)
        if wanted.codes:
            yield wanted


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               item_column: str = "item_id", item_text: str = "text", q: int = Q,
               edit_rate: float = EDIT_RATE) -> DataFrame:
    """One row per occurrence of an item in a document; documents without any have no row.

    Columns: the two ids, ``edits``, ``start`` and ``stop`` (characters of the document) and
    ``shared_grams`` (the most that a band of the occurrence has). Null texts and items without id hold nothing; repeated rows of documents each count,
    repeated items once. Other columns are left out.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    item_type = benchmark.schema[item_column].dataType.simpleString()
    schema = (f"`{id_column}` {id_type}, `{item_column}` {item_type}, edits int, start bigint, stop bigint, "
              "shared_grams int")
    names = [id_column, item_column, "edits", "start", "stop", "shared_grams"]
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    out = spark.createDataFrame([], schema)

    def search(held):
        def run(batches):
            wanted = held.value
            for rows, block in blocks(batches, "text"):
                found = [(d, i, *rest) for d, p, *rest in find_in_block(block, wanted) for i in wanted.items[p]]
                if found:
                    docs_found, *columns = map(list, zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pa.array(docs_found)), pa.array(columns[0]),
                         pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                         pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int32())], names)
        return run

    for wanted in _query_blocks(benchmark, item_column, item_text, q, edit_rate):
        out = out.unionByName(texts.mapInArrow(search(spark.sparkContext.broadcast(wanted)), schema))
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
                 item_text: str = "text", q: int = Q, edit_rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of the benchmark, with all their columns.

    Null and empty texts hold none and stay, repeated rows are judged each on its own, and whatever the names of
    the columns are they stay as they are. An empty benchmark keeps all rows, an empty table has none.
    """
    def keep(held):
        def run(batches):
            wanted = held.value
            for rows, block in blocks(batches, text_column):
                clean = np.ones(len(block), bool)
                clean[[d for d, *_ in find_in_block(block, wanted)]] = False
                yield rows.filter(pa.array(clean))
        return run

    for wanted in _query_blocks(benchmark, item_column, item_text, q, edit_rate):
        docs = docs.mapInArrow(keep(docs.sparkSession.sparkContext.broadcast(wanted)), docs.schema)
    return docs
