"""Splitting of texts before byte-pair merging."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# Fixed value: the pattern of the byte-level vocabularies, for which the plain form below is the same.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters of texts that need no Unicode tables: Latin with its first supplements, less the two signs among them.
PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_NOT_PLAIN = re.compile(rf"[^\t\n\r -~{PLAIN_LETTERS}]")
_PLAIN_SPLIT = re.compile(
    rf" ?[{PLAIN_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{PLAIN_LETTERS}0-9]+|\s+(?!\S)|\s+"
)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Function that gives the matches of a pattern in a text.

    For plain texts and the byte-level pattern, classes written out give the same twice as fast.
    """
    general = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL_PATTERN:
        return general
    return lambda text: _PLAIN_SPLIT.findall(text) if _NOT_PLAIN.search(text) is None else general(text)


def byte_characters() -> list[str]:
    """A character for each byte: printable ones stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(own))
    return [c for _, c in sorted([*((b, chr(b)) for b in own), *((b, chr(0x100 + n)) for n, b in enumerate(rest))])]


class Kept:
    """Values of pre-tokens seen lately: at most twice ``limit`` characters of them, besides those of one text.

    Every pre-token counts ``OVERHEAD`` characters on top of its own. When ``limit`` is reached, what
    is kept becomes the older half, and the former older half is forgotten; what is asked for again
    moves to the newer half. So frequent pre-tokens stay, and long ones soon make room.
    """

    OVERHEAD = 32

    def __init__(self, limit: int):
        self.limit = limit
        self.size = 0
        self.newer: dict = {}
        self.older: dict = {}

    def missing(self, parts: list[str]) -> list[str]:
        """Those of ``parts`` that have no value; all others are in the newer half afterwards."""
        if self.size > self.limit:
            self.older, self.newer, self.size = self.newer, {}, 0
        new = []
        for part in set(parts).difference(self.newer):
            self.size += self.OVERHEAD + len(part)
            value = self.older.get(part)
            if value is None:
                new.append(part)
            else:
                self.newer[part] = value
        return new
