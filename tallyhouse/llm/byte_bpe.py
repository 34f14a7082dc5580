"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that its encoding can end with: the token
``t`` such that the encoding of the rest of the prefix ends with a token that may stand before ``t``. Two
tokens may stand side by side if merging never joins across their border, which is decided by undoing
their merges from the latest to the earliest. Storing that last token for each prefix gives the encoding
by walking back from the end, and

* appending bytes only adds entries, exactly as if the longer string had been encoded anew;
* after an edit only the entries behind it are computed again, and no further than to the point where as
  many entries in a row as the longest token has bytes agree with the old ones.

Documents are split by a pattern first, and merges stay within a match.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from tallyhouse.llm.pieces import PieceEncoder
from tallyhouse.llm.text import blocks

assert sys.byteorder == "little"


class Vocabulary:
    """Byte strings by rank; rank order is the order in which merges were learned."""

    MAX_PAIRS = 1_000_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._step: dict[tuple[int, int], int] = {}
        self._token_at: list[int] = [-1]
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            parts = (rank, rank) if len(token) == 1 else self._last_merge(token, rank)
            if parts is not None:
                self.halves[rank] = parts
                self._add(token, rank)
        self.pairs.clear()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two earlier tokens whose merge makes this one; None if merging never makes it."""
        for i in range(1, len(token)):
            left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
            if (left is not None and right is not None and left < rank and right < rank
                    and left in self.halves and right in self.halves
                    and self._side_by_side(left, right, rank)):
                return left, right
        return None

    def _add(self, token: bytes, rank: int) -> None:
        """Enter the token, read backwards, into the tree of endings."""
        node = 0
        for byte in reversed(token):
            key = (node, byte)
            node = self._step.get(key, 0)
            if not node:
                node = self._step[key] = len(self._token_at)
                self._token_at.append(-1)
        self._token_at[node] = rank

    def _side_by_side(self, left: int, right: int, before: int) -> bool:
        """Whether merges of a rank below ``before`` leave the border between two tokens alone."""
        limit = before
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < limit:
                return False
            # Undo the later of the two merges; what stood at the border then is the next pair.
            if left > right:
                limit = left
                left = self.halves[left][1]
                if left == limit:
                    limit = right + 1
                    right = self.halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = self.halves[right][0]
                if right + 1 == limit:
                    limit = left
                    left = self.halves[left][1]
                    if left == limit:
                        return True

    def may_follow(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._side_by_side(left, right, 1 << 62)
        return known

    def last_token(self, data, last: list[int], end: int) -> int:
        """The token that ends the encoding of ``data[:end]``, given those of all shorter prefixes."""
        node, start, step, tokens, known = 0, end, self._step, self._token_at, self.pairs
        while start:
            start -= 1
            node = step.get((node, data[start]), 0)
            if not node:
                break
            token = tokens[node]
            if token >= 0:
                if not start:
                    return token
                fits = known.get((last[start], token))
                if fits or fits is None and self.may_follow(last[start], token):
                    return token
        raise ValueError(f"byte {data[end - 1]} has no token")

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is itself in the vocabulary is one id."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return Encoding(self, piece).tokens()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Encoding:
    """A byte string with the last token of each of its prefixes, open to appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self._last = vocabulary, bytearray(), [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        data, last, find = self.data, self._last, self.vocabulary.last_token
        begin = len(data)
        data += more
        for end in range(begin + 1, len(data) + 1):
            last.append(find(data, last, end))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were computed."""
        old, shift = self._last, start + len(new) - stop
        self.data[start:stop] = new
        self._last = last = old[:start + 1]
        same, find, done = 0, self.vocabulary.last_token, 0
        for end in range(start + 1, len(self.data) + 1):
            last.append(find(self.data, last, end))
            done += 1
            if end > start + len(new):
                same = same + 1 if last[end] == old[end - shift] else 0
                if same >= self.vocabulary.longest:
                    last.extend(old[end - shift + 1:])
                    break
        return done

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the string, or of its first ``end`` bytes."""
        out, at, sizes = [], len(self.data) if end is None else end, self.vocabulary.bytes_of
        while at:
            out.append(self._last[at])
            at -= len(sizes[out[-1]])
        return out[::-1]


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Vocabulary:
    """A rank file: a base64 byte string and its rank in each line."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> PieceEncoder:
    vocabulary = load_ranks(path)
    return PieceEncoder(lambda piece: array("I", vocabulary.encode_piece(piece.encode())).tobytes(), pattern=pattern)


def encode_text(text: str, path: str, pattern: str = public_tokenizers.PATTERN) -> list[int]:
    """Ids of one text."""
    return array("I", _encoder(path, pattern).encode(text)).tolist()


_OUTPUTS = {
    "ids": ("binary", pa.binary()), "n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
                     outputs=("ids", "n_tokens"), pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per row of ``docs``: its id and, of its whole text, the outputs asked for.

    ``ids`` are little-endian unsigned 32-bit integers; ``decoded_sha256`` is taken from the bytes that the
    ids decode to. A null text is empty and has no ids. Other columns are left out, repeated rows stay.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        encoder = _encoder(path, pattern)
        decode = load_ranks(path).decode
        for rows, block in blocks(batches, "text"):
            found = {name: [] for name in outputs}
            for text in rows.column(1).to_pylist():
                ids = encoder.encode(text or "")
                if "ids" in found:
                    found["ids"].append(ids)
                if "n_tokens" in found:
                    found["n_tokens"].append(len(ids) // 4)
                if "ids_sha256" in found:
                    found["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                if "decoded_sha256" in found:
                    found["decoded_sha256"].append(hashlib.sha256(decode(array("I", ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0)] + [pa.array(found[n], _OUTPUTS[n][1]) for n in outputs], ["id", *outputs])

    schema = f"id {id_type}, " + ", ".join(f"{n} {_OUTPUTS[n][0]}" for n in outputs)
    return docs.selectExpr(f"`{id_column}` as id", f"`{text_column}` as text").mapInArrow(run, schema) \
        .withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: its id and ``decoded``, the bytes of its ids (null ids: null)."""
    id_type = encoded.schema[id_column].dataType.simpleString()

    def run(batches):
        decode = load_ranks(path).decode
        for batch in batches:
            found = [None if ids is None else decode(array("I", ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "decoded"])

    return encoded.selectExpr(f"`{id_column}` as id", f"`{ids_column}` as ids") \
        .mapInArrow(run, f"id {id_type}, decoded binary").withColumnRenamed("id", id_column)
