"""Canonical length-limited Huffman codes over a bounded alphabet of ids, on numpy arrays.

Code lengths come from package-merge (Larmore and Hirschberg 1990). Bits are written from the highest bit of each byte on.
Decoding looks ``limit`` bits up in one table; many checkpoints of a block advance together.
"""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code, at most ``limit``; 0 for symbols that never occur. Ties go to the smaller symbol."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < len(weights))
        merged = merged[rank]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    take, lengths = 2 * len(used) - 2, np.zeros(len(used), dtype=np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


class Code:
    """The canonical code of given lengths: shorter codes first, then smaller symbols."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.limit = max(1, int(self.lengths.max(initial=1)))
        symbols = np.flatnonzero(lengths)
        symbols = symbols[np.argsort(lengths[symbols], kind="stable")]
        size = self.lengths[symbols]
        spans = np.left_shift(1, self.limit - size)
        first = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[symbols] = (first >> (self.limit - size)).astype(np.uint64)
        self.symbol_at = np.zeros(1 << self.limit, dtype=np.uint32)
        self.length_at = np.zeros(1 << self.limit, dtype=np.int64)
        covered = int(spans.sum())
        self.symbol_at[:covered] = np.repeat(symbols, spans)
        self.length_at[:covered] = np.repeat(size, spans)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """(payload, bit offset of each ``every``-th id)."""
        if not len(ids):
            return b"", np.zeros(0, dtype=np.int64)
        sizes = self.lengths[ids]
        to = np.cumsum(sizes)
        at = to - sizes
        word, free = at >> 6, 64 - (at & 63) - sizes
        codes = self.codes[ids]
        inside = np.where(free >= 0, codes << np.maximum(free, 0).astype(np.uint64), codes >> np.maximum(-free, 0).astype(np.uint64))
        out = np.zeros(int(to[-1] >> 6) + 2, dtype=np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.add.reduceat(inside, first)
        over = np.flatnonzero(free < 0)
        out[word[over] + 1] += codes[over] << (64 + free[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: int(to[-1] + 7 >> 3)], at[::every]

    def decode(self, payload: bytes, checkpoints: np.ndarray, count: int, every: int) -> np.ndarray:
        """The ``count`` ids of a block."""
        if not count:
            return np.zeros(0, dtype=np.uint32)
        data = np.frombuffer(payload + bytes(every * self.limit // 8 + 16), dtype=np.uint8)
        eight = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))
        at = np.asarray(checkpoints, dtype=np.int64).copy()
        out = np.empty((every, len(at)), dtype=np.uint32)
        rest = np.uint64(64 - self.limit)
        for i in range(every):
            bits = eight[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64) >> rest
            out[i] = self.symbol_at[bits]
            at += self.length_at[bits]
        return out.T.ravel()[:count]
