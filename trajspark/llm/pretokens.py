"""Pre-tokens of byte-level tokenizers as numpy arrays, and ids of texts from the ids of their distinct pre-tokens.

The pattern is the one of ``public_tokenizers.PATTERN``: contractions; letters, digits or other characters, each with one
space before; white space that leaves its last character to what follows; white space. Characters are sorted into four
classes; a pre-token starts where the class changes, and then a few starts move.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np

from trajspark.llm.words import Texts, span_hashes

SPACE, LETTER, NUMBER, OTHER = range(4)
CACHE_ENTRIES = 300_000


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of each character, and whether the class depends on the edition of Unicode."""
    kinds, young = np.full(0x110000, OTHER, dtype=np.uint8), np.zeros(0x110000, dtype=bool)
    old = unicodedata.ucd_3_2_0
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            kinds[code] = LETTER
        elif kind[0] == "N":
            kinds[code] = NUMBER
        if code > 127:
            then = old.category(chr(code))
            young[code] = then[0] != kind[0] or kind == "Cn"
    for code in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        kinds[code] = SPACE
    return kinds, young


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte each character starts at, code point) of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    codes = lead.astype(np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.int64)
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        who = np.flatnonzero((lead >= low) & (lead < high))
        code = codes[who] & mask
        for i in range(1, more + 1):
            code = code << 6 | (padded[at[who] + i] & 0x3F)
        codes[who] = code
    return at, codes


class Pretokens:
    """``starts`` and ``ends`` are byte bounds in ``data``; ``bounds[i]:bounds[i + 1]`` are the pre-tokens of text i."""

    def __init__(self, texts: Texts):
        n = len(texts.bytes)
        self.data = np.zeros(n + 8, dtype=np.uint8)
        self.data[:n] = texts.bytes
        at, codes = characters(texts.bytes)
        kinds, young = _tables()
        first = np.searchsorted(at, texts.offsets)  # character each text starts at
        start = self._starts(codes, kinds[codes], first[:-1])
        self.starts = at[start]
        self.ends = np.append(self.starts[1:], n)
        self.bounds = np.searchsorted(self.starts, texts.offsets)
        doubt = np.concatenate([[0], np.cumsum(young[codes])])
        self.doubtful = np.flatnonzero(doubt[first[1:]] > doubt[first[:-1]])

    @staticmethod
    def _starts(codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(codes)
        if not n:
            return np.zeros(0, dtype=np.int64)
        head = np.zeros(n + 1, dtype=bool)  # first character of a text, or the end
        head[first] = True
        head[n] = True
        start = head[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        runs = start.copy()
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~head[1:n])  # white space before something
        blank = last[codes[last] == 32]
        start[blank + 1] = False
        start[last] = True
        quote = np.flatnonzero((codes[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~head[1:n])
        one = quote[np.isin(codes[quote + 1], [ord(c) for c in "stmd"])]
        two = quote[(quote + 2 < n)]
        two = two[~head[two + 2]]
        a, b = codes[two + 1], codes[two + 2]
        two = two[((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))]
        for who, size in ((one, 2), (two, 3)):
            start[who + 1] = False
            rest = who + size
            start[rest[rest < n]] |= ~head[rest[rest < n]] & (kind[rest[rest < n]] == LETTER) | runs[rest[rest < n]]
        return np.flatnonzero(start)

    def piece(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


class Encoder:
    """Ids of texts. ``encode_new`` maps pre-tokens to (their ids one after another, how many each has).

    The answers for up to ``entries`` distinct pre-tokens are kept, under 64-bit hashes in sorted arrays; then a new set is begun.
    """

    def __init__(self, encode_new: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], entries: int = CACHE_ENTRIES):
        self.encode_new, self.entries = encode_new, entries
        self.forget()

    def forget(self) -> None:
        self.hashes, self.begin, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, pretokens: Pretokens, hashes: np.ndarray, sample: np.ndarray) -> None:
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), dtype=bool)
        new[at < len(self.hashes)] = self.hashes[at[at < len(self.hashes)]] != hashes[at < len(self.hashes)]
        if len(self.hashes) and len(self.hashes) + new.sum() > self.entries:
            self.forget()
            return self._learn(pretokens, hashes, sample)
        if new.any():
            raw, who = pretokens.data.tobytes(), sample[new]
            pieces = [raw[a:b] for a, b in zip(pretokens.starts[who].tolist(), pretokens.ends[who].tolist(), strict=True)]
            flat, sizes = self.encode_new(pieces)
            self.begin = np.insert(self.begin, at[new], len(self.flat) + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, at[new], sizes)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.flat = np.concatenate([self.flat, flat])
        return None

    def ids(self, pretokens: Pretokens) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of the texts in them)."""
        hashes, sample, codes = np.unique(
            span_hashes(pretokens.data, pretokens.starts, pretokens.ends), return_index=True, return_inverse=True)
        self._learn(pretokens, hashes, sample)
        own = np.searchsorted(self.hashes, hashes)
        each = self.sizes[own][codes]
        to = np.cumsum(each)
        source = np.repeat(self.begin[own][codes] - (to - each), each)
        source += np.arange(len(source))
        return self.flat[source], np.concatenate([[0], to])[pretokens.bounds]
