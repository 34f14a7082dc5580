"""Encoding texts piece by piece, with the ids of frequent pieces kept.

Byte-level vocabularies merge within the matches of one pattern only, so the ids of a text are the ids of
its matches in a row, and a match found once need not be encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import public_tokenizers
import regex

# The same pattern for texts of ASCII and Western European letters, where the faster matcher gives equal
# matches. What begins with a letter can match in one way only, so that case stands first.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SPACE = r"\t-\r "
_WESTERN = (rf" ?[{_LETTER}]++|'(?:s|t|re|ve|m|ll|d)| ?[0-9]++| ?[^{_SPACE}{_LETTER}0-9]++"
            rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


@cache
def _patterns(pattern: str):
    whole = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    return whole.findall, re.compile(_WESTERN).findall, re.compile(rf"[\x00-\x7f{_LETTER}]*+").fullmatch


def split(text: str, pattern: str = public_tokenizers.PATTERN) -> list[str]:
    """Matches of the pattern, which cover the text."""
    whole, western, is_western = _patterns(pattern)
    if pattern == public_tokenizers.PATTERN and (text.isascii() or is_western(text)):
        return western(text)
    return whole(text)


class PieceEncoder(dict):
    """Ids of texts as little-endian unsigned 32-bit integers; as a mapping, the ids of single pieces.

    ``encode_piece`` gives the ids of a piece. The first ``capacity`` pieces of at most ``longest``
    characters are kept for the life of the worker; the others are encoded whenever they appear, which
    bounds the memory and changes no result.
    """

    def __init__(self, encode_piece: Callable[[str], bytes], capacity: int = 600_000, longest: int = 64,
                 pattern: str = public_tokenizers.PATTERN):
        super().__init__()
        self.encode_piece, self.capacity, self.longest, self.pattern = encode_piece, capacity, longest, pattern

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode_piece(piece)
        if len(self) < self.capacity and len(piece) <= self.longest:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, split(text, self.pattern)))
