"""Word shingles of a text as 32-bit hashes, in numpy over UTF-8 bytes.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all characters past 0x7F. A text
of fewer words than a shingle takes has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORDS = 5
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_JOIN = np.uint64(0xD6E8FEB86659FD93)

_IS_WORD = np.zeros(256, np.int8)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK, np.uint64(base & 0xFFFFFFFFFFFFFFFF))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def blocks(data: bytes, gap: re.Pattern) -> Iterator[bytes]:
    """The bytes in pieces of about a megabyte, each ending before a byte that gap matches."""
    at = 0
    while at < len(data):
        found = gap.search(data, at + _BLOCK) if at + _BLOCK < len(data) else None
        end = found.start() if found else len(data)
        yield data[at:end]
        at = end


def word_hashes(data: bytes, is_word: np.ndarray = _IS_WORD, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, in order: differences of a running polynomial sum, scaled back to the word's start.

    is_word tells the bytes of words (1) from others (0); fold lower-cases A-Z first.
    """
    if not _tables:
        _tables.extend([_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))])
    out, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + _BLOCK)
        if end < n:  # at a word's end, unless one word fills the block
            back = end
            while back > at and is_word[data[back - 1] | (0x20 if fold and 0x41 <= data[back - 1] <= 0x5A else 0)]:
                back -= 1
            end = back if back > at else end
        a = np.frombuffer(data[at:end].lower() if fold else data[at:end], np.uint8)
        edges = np.flatnonzero(np.diff(is_word[a], prepend=np.int8(0), append=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _tables[0][: len(a)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[starts]) * _tables[1][starts]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted 32-bit hashes of all shingles, repeats included."""
    h = word_hashes(text or b"")
    width = min(words, len(h))
    if not width:
        return np.zeros(0, np.uint32)
    s = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        s = s * _JOIN + h[k : len(h) - width + 1 + k]
    return np.sort((mixed(s) >> np.uint64(32)).astype(np.uint32))
