"""Spelling variants: words of the corpus that are one edit apart, and the common form of rare ones.

Two words that are one edit apart agree in their first half or, where the edit is there, in their second,
and their lengths differ by one at most. So the vocabulary is dealt into buckets by length and half: each word
stands in four, for either half and for two lengths, and no pair is lost. Their number follows the size of
the vocabulary. A bucket that is large all the same is cut into shards, and pairs of shards are dealt out.

A shard is indexed by bit sets over its words, one for each position and letter. A word is looked up with
all its letters in turn: the set of words that agree so far and, for each kind of edit, the set of those that
needed one go through the same step, by whole machine words; after a letter too many or too few, positions
are shifted by one. Many words are looked up at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.rows import sorted_groups
from tallyhouse.llm.text import give_back, stored

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SHARD_LETTERS = 1 << 15
LENGTH_CLASSES = 64
HELD_WORDS = 200_000
TYPO = 31
_LOOK_UP = 1 << 15


def _counts(batches, min_length: int, typo: int | None):
    """Partial counts of words; at most ``HELD_WORDS`` different ones are held at a time."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)
    held: Counter[str] = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = Counter(run.findall(text.as_buffer().to_pybytes().lower().decode())) if text.is_valid else {}
            if typo is None:
                held.update(found)
            else:
                seed = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % typo == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield flush()
    yield flush()
    give_back()


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, typo: int | None = None) -> DataFrame:
    """Words of ``min_length`` letters that occur ``min_count`` times in all, with that number as ``n``.

    Words are the maximal runs of Latin letters of every text, A-Z lowered. With ``typo``, a word whose
    checksum together with its document's id is divisible by it loses one letter, before lengths count.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").alias("text"))
    found = rows.mapInArrow(lambda batches: _counts(batches, min_length, typo), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _half(longest):
    """Letters of the first half, of a word or the one with a letter less."""
    return (longest - 1) // 2


@dataclass
class Shard:
    """Words with one byte a letter, laid end to end: word ``i`` is ``letters[begin[i]:begin[i] + length[i]]``."""

    letters: np.ndarray
    begin: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, words) -> Shard:
        raw = [w.encode("latin-1") for w in words]
        length = np.array([len(w) for w in raw], np.int64)
        return cls(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(length) - length, length)

    def of_length(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.length == n)

    def matrix(self, which: np.ndarray, n: int) -> np.ndarray:
        """Letters of words that have ``n`` letters each, one row per word."""
        return self.letters[self.begin[which, None] + np.arange(n)]


class PositionIndex:
    """For each position and letter the set of words that have it there, one bit per word."""

    def __init__(self, shard: Shard):
        word = np.repeat(np.arange(len(shard.length)), shard.length)
        at = np.arange(len(word)) - np.repeat(shard.begin, shard.length)
        self.keys, row = np.unique(at * 256 + shard.letters, return_inverse=True)
        self.words = len(shard.length)
        self.width = (self.words + 63) // 64
        # The last row stands for what no word has.
        self.sets = np.zeros((len(self.keys) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.sets, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        self.shard = shard

    def members(self, which: np.ndarray) -> np.ndarray:
        bits = np.zeros(self.width * 64, bool)
        bits[which] = True
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def rows(self, letters: np.ndarray, shift: int) -> np.ndarray:
        """Which set holds the words with each given letter at its place moved by ``shift``."""
        keys = (np.arange(letters.shape[1]) + shift) * 256 + letters
        row = np.searchsorted(self.keys, keys)
        found = (keys >= 0) & (self.keys[np.minimum(row, len(self.keys) - 1)] == keys)
        return np.where(found, row, len(self.keys))

    def near(self, letters: np.ndarray, same_length: np.ndarray, other: np.ndarray, other_is_longer: bool,
             half: int, agreeing: bool) -> np.ndarray:
        """For each row of ``letters`` the set of words one edit away.

        ``same_length`` holds the words that a replaced letter may lead to, ``other`` those with a letter more
        or less. Only words count that agree in the first ``half`` letters, or only those that do not.
        """
        n = letters.shape[1]
        here, moved = self.rows(letters, 0), self.rows(letters, 1 if other_is_longer else -1)
        exact = np.full((len(letters), self.width), ~np.uint64(0))
        replaced, shifted = np.zeros_like(exact), np.zeros_like(exact)
        if other_is_longer:
            shifted |= exact
        for i in range(n):
            has = self.sets[here[:, i]]
            replaced &= has
            replaced |= exact & ~has
            shifted &= self.sets[moved[:, i]]
            if not other_is_longer:
                shifted |= exact
            exact &= has
            if other_is_longer:
                shifted |= exact
            if i + 1 == half:
                counted = exact.copy() if agreeing else ~exact
        return ((replaced & same_length) | (shifted & other)) & counted


def near_words(index: PositionIndex, asked: Shard, longest: int, agreeing: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each asked word the number of index words that are one edit away, and the first of them or -1.

    Pairs of two words of ``longest`` letters count, and pairs of one of those and one with a letter less; of
    these the ones that agree in their first half, or the others.
    """
    long, short = (index.members(index.shard.of_length(n)) for n in (longest, longest - 1))
    nothing = np.zeros_like(long)
    n_near, first = np.zeros(len(asked.length), np.int64), np.full(len(asked.length), -1)
    step = max(1, _LOOK_UP // index.width)
    for n in (longest, longest - 1):
        same, other = (long, short) if n == longest else (nothing, long)
        which = asked.of_length(n)
        for k in range(0, len(which), step):
            part = which[k:k + step]
            found = index.near(asked.matrix(part, n), same, other, n < longest, _half(longest), agreeing)
            n_near[part] = np.bitwise_count(found).sum(axis=1)
            block = np.argmax(found != 0, axis=1)
            bits = found[np.arange(len(part)), block]
            place = np.bitwise_count((bits & -bits) - np.uint64(1))
            first[part] = np.where(bits != 0, block * 64 + place, -1)
    return n_near, first


def _search(group: pa.Table):
    """Near words within a bucket and pair of shards; a shard's words come in the order of their rank as a form."""
    longest, side, _, i, j = (group.column(k)[0].as_py() for k in range(5))
    own, words, n = group.column("own").to_numpy(), group.column("word"), group.column("n").to_numpy()
    parts = [np.flatnonzero(own == s) for s in sorted({i, j})]
    shards = [Shard.of(words.take(pa.array(p)).to_pylist()) for p in parts]
    for index_of, asked_of in ((0, 0),) if i == j else ((0, 1), (1, 0)):
        if not len(parts[index_of]) or not len(parts[asked_of]):
            continue
        n_near, first = near_words(PositionIndex(shards[index_of]), shards[asked_of], longest, side == 0)
        some = np.flatnonzero(n_near)
        if len(some):
            best = parts[index_of][first[some]]
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(parts[asked_of][some])).combine_chunks(), pa.array(n_near[some]),
                 words.take(pa.array(best)).combine_chunks(), pa.array(n[best])], ["word", "n_near", "form", "form_n"])


def _dealt(words: DataFrame, shard_letters: int) -> DataFrame:
    """Words by ``longest``, ``side`` (which half), ``bucket`` and pair of shards ``i``, ``j``."""
    length = F.length("word")
    half = F.when(F.col("side") == 0, F.expr("left(word, cast((longest - 1) div 2 as int))")).otherwise(
        F.expr("right(word, cast(longest - 1 - (longest - 1) div 2 as int))"))
    placed = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longest")).select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).withColumns({
            "half": F.xxhash64(half), "class": F.least("longest", F.lit(LENGTH_CLASSES))})
    # Not more rows than there are classes, whatever the vocabulary.
    sizes = placed.groupBy("class").agg(F.ceil(F.sum(length) / (2 * shard_letters)).alias("buckets"))
    keys = ["longest", "side", "bucket"]
    placed = placed.join(F.broadcast(sizes), "class").select(
        "longest", "side", F.pmod("half", F.col("buckets")).alias("bucket"), "word", "n")
    large = placed.groupBy(*keys).agg(
        F.ceil(F.sum(length) / (2 * shard_letters)).cast("int").alias("shards")).filter("shards > 1")
    own = F.pmod(F.xxhash64("word"), F.col("shards")).cast("int")
    return placed.join(large, keys, "left").withColumn("shards", F.coalesce("shards", F.lit(1))).select(
        *keys, "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")
    ).select(*keys, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "word", "n")


def neighbours(words: DataFrame, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """For each word with any: ``n_near``, and of the words one edit away the most frequent with its number.

    ``words`` has distinct words of three letters or more (column ``word``) and their ``n``.
    """
    keys = ["longest", "side", "bucket", "i", "j"]

    def run(batches):
        for group in sorted_groups(batches, len(keys)):
            if group.num_rows > 1:
                yield from _search(group)

    found = _dealt(words, shard_letters).repartition(*keys).sortWithinPartitions(*keys, F.desc("n"), "word") \
        .mapInArrow(run, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))


def follow(forms: DataFrame) -> DataFrame:
    """The last word (``root``) that the forms of a word lead to; ``forms`` has a row for words with a form.

    Each round doubles the way; since a form is several times as frequent, ways are short.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = ways.select(F.col("word").alias("via"), F.col("root").alias("further"))
        longer = stored(ways.join(on, ways["root"] == on["via"], "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        if longer.filter("moved").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, typo: int | None = None,
             shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the most frequent word one edit away (of equal ones the smallest by code points) if it is at
    least ``ratio`` times as frequent, else null, and ``form_n`` its number; ``root`` is where the forms lead,
    or the word itself. Null and empty texts hold no words, repeated rows and shared ids count each, a null id
    counts as the empty text in checksums, and an empty table gives no rows. Other columns are left out,
    whatever their names.
    """
    if min_length < 3 or ratio < 2:
        raise ValueError("words need three letters at least, and forms twice the number of their word")
    words = stored(vocabulary(docs, id_column, text_column, min_length, min_count, typo), "vocabulary")
    near = neighbours(words, shard_letters).withColumnRenamed("word", "near_word")
    common = F.col("form_n") >= ratio * F.col("n")
    judged = stored(words.join(near, words["word"] == near["near_word"], "left").select(
        "word", F.when(common, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("form_n")).alias("form_n")), "variants")
    roots = follow(judged.filter("form is not null")).withColumnRenamed("word", "rooted")
    return judged.join(roots, judged["word"] == roots["rooted"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
