"""Line-first cleaning: each line is judged, failing lines go, and a text that loses too much is rejected.

A line is a ``\\n``-separated part of a text that holds a word (a run of bytes other than ASCII white
space). It fails by

* punctuation: it does not end in a closing mark (a line of ten words or more also passes if a sentence
  ends inside it), or has four or more noise characters and one for every two words;
* navigation: three or more bars, or a bar for every four words;
* boilerplate: it contains one of the ``phrases``, A-Z taken as a-z.

A text is kept unless the base counts fail (fewer than 10 words, or over 20 % of its words in windows of
five words that occur twice in it) or its failing lines hold more than ``max_lost_pct`` percent of its
words. A null or empty text has no words, fails the base and keeps a null or empty ``clean_text``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.text import (
    LOWER, SPACE, Block, blocks, find_words, prefix_hash, span_hash, window_hashes)

# Fixed values.
SYMBOLS = b"#*$%&|<>"
NOISE = b"#*$%&|<>!?"
CLOSING = b".!?\"':;)"
CLOSING_WIDE = ("”", "’", "…", "»", "。", "！", "？")
PHRASES = ("all rights reserved", "licensed under", "terms of use", "privacy policy", "use of cookies",
           "accept cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our")
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOST_PCT = 50
WINDOW = 5
PROSE_WORDS = 10


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_IS_SYMBOL, _IS_NOISE, _IS_CLOSING, _IS_STOP = map(_table, (SYMBOLS, NOISE, CLOSING, b".!?"))
_COLUMNS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
            ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_lines", pa.int64()),
            ("n_bad_lines", pa.int64()), ("n_lost_words", pa.int64()), ("base_failed", pa.bool_()),
            ("kept", pa.bool_()), ("clean_text", pa.string()))


@dataclass
class Lines:
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    words: np.ndarray
    last: np.ndarray


def find_lines(block: Block, words) -> Lines:
    """Lines with a word: byte spans, document, number of words, and the last byte that is no space."""
    breaks = np.flatnonzero(block.data == 10)
    cuts = np.unique(np.concatenate([block.offsets[:-1], breaks + 1]))
    cuts = cuts[cuts < len(block.data)]
    ends = np.append(cuts[1:], len(block.data))[:len(cuts)]
    ends = ends - (block.data[ends - 1] == 10)
    first = np.searchsorted(words.starts, cuts)
    n = np.diff(np.append(first, len(words.starts)))
    some = n > 0
    cuts, ends, first, n = cuts[some], ends[some], first[some], n[some]
    return Lines(cuts, ends, block.doc_of(cuts), n, words.ends[first + n - 1] - 1 if len(first) else first)


def failing_lines(block: Block, lines: Lines, phrases) -> np.ndarray:
    """Which lines fail a rule."""
    def count(table):
        total = np.concatenate([[0], np.cumsum(table[block.data])])
        return total[lines.ends] - total[lines.starts]

    closes = _IS_CLOSING[block.data[lines.last]] if len(lines.last) else np.zeros(0, bool)
    for i in np.flatnonzero(~closes & (block.data[lines.last] >= 128)) if len(lines.last) else ():
        tail = block.data[max(lines.starts[i], lines.last[i] - 2):lines.last[i] + 1].tobytes()
        closes[i] = tail.decode("utf-8", "ignore").endswith(CLOSING_WIDE)
    ends = _IS_STOP[block.data]
    ends[:-1] &= SPACE[block.data[1:]]
    total = np.concatenate([[0], np.cumsum(ends)])
    prose = (lines.words >= PROSE_WORDS) & (total[lines.ends] > total[lines.starts])
    noise, bars = count(_IS_NOISE), count(_table(b"|"))
    bad = ~(closes | prose) | ((noise >= 4) & (2 * noise > lines.words))
    bad |= (bars >= 3) | ((bars >= 1) & (4 * bars >= lines.words))
    if phrases and len(lines.starts):
        lowered = LOWER[block.data].tobytes()
        found = re.compile(b"|".join(re.escape(p.encode()) for p in phrases))
        for match in found.finditer(lowered):
            line = np.searchsorted(lines.starts, match.start(), side="right") - 1
            if line >= 0 and match.end() <= lines.ends[line]:
                bad[line] = True
    return bad


def _first_of_equal(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item the index of the first equal item of its document, and how many there are."""
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    group = np.cumsum(new) - 1
    first, many = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    first[order] = order[new][group]
    many[order] = np.bincount(group)[group] if len(group) else group
    return first, many


def judge(block: Block, phrases=PHRASES, max_lost_pct: int = MAX_LOST_PCT) -> dict[str, np.ndarray]:
    """All counts and verdicts of a block, one entry per document."""
    n_docs, words = len(block), find_words(block)
    prefix = prefix_hash(block.data)
    lines = find_lines(block, words)
    inside = ~SPACE[block.data]
    tally = lambda doc, weights=None: np.bincount(doc, weights, minlength=n_docs).astype(np.int64)
    out = {
        "n_words": np.diff(words.first),
        "word_chars": block.sums(inside & ((block.data & 0xC0) != 0x80)),
        "n_symbols": block.sums(_IS_SYMBOL[block.data]),
    }
    first, _ = _first_of_equal(lines.doc, span_hash(prefix, lines.starts, lines.ends))
    out["n_dup_lines"] = tally(lines.doc, first != np.arange(len(first)))
    windows, at = window_hashes(span_hash(prefix, words.starts, words.ends), words.doc, WINDOW)
    _, many = _first_of_equal(words.doc[at], windows)
    covered = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(covered, at[many > 1], 1)
    np.add.at(covered, at[many > 1] + WINDOW, -1)
    out["n_repeat_words"] = tally(words.doc, np.cumsum(covered[:-1]) > 0)
    bad = failing_lines(block, lines, phrases)
    out["n_lines"], out["n_bad_lines"] = tally(lines.doc), tally(lines.doc, bad)
    out["n_lost_words"] = tally(lines.doc, bad * lines.words)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PCT * out["n_words"])
    out["kept"] = ~out["base_failed"] & (100 * out["n_lost_words"] <= max_lost_pct * out["n_words"])
    keep = np.ones(len(block.data), bool)
    for a, b in zip(lines.starts[bad], lines.ends[bad]):
        keep[a:b + 1 if b < len(block.data) and block.data[b] == 10 else b] = False
    out["clean_text"] = [
        None if null else block.data[a:b][keep[a:b]].tobytes().decode()
        for a, b, null in zip(block.offsets, block.offsets[1:], block.is_null)]
    return out


def clean_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases=PHRASES,
                max_lost_pct: int = MAX_LOST_PCT, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: its id, the counts, both verdicts and, if asked for, the cleaned text.

    Rows are judged one by one, so repeated rows and ids stay as they are; other columns are left out.
    ``clean_text`` is the text without its failing lines (and their line breaks).
    """
    names = [name for name, _ in _COLUMNS if with_text or name != "clean_text"]
    kinds = {"n": "bigint", "w": "bigint", "b": "boolean", "k": "boolean", "c": "string"}
    id_type = docs.schema[id_column].dataType.simpleString()
    types = dict(_COLUMNS)

    def run(batches):
        for rows, block in blocks(batches, "text"):
            found = judge(block, phrases, max_lost_pct)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0)] + [pa.array(found[n], types[n]) for n in names], ["id"] + names)

    schema = f"id {id_type}, " + ", ".join(f"{n} {kinds[n[0]]}" for n in names)
    return docs.selectExpr(f"`{id_column}` as id", f"`{text_column}` as text").mapInArrow(run, schema) \
        .withColumnRenamed("id", id_column)
