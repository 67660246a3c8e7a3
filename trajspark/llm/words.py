"""Words of whole texts as numpy arrays: bounds, 64-bit hashes, window hashes. Used inside Spark tasks on Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None

CHUNK_BYTES = 2 << 20
LONG_WORD = 1024

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def release_memory() -> None:
    """Hand back what the Arrow pool and the C heap hold unused, so that a worker that is used again doesn't keep the peak of its last task."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


class Texts:
    """Texts one after another in one byte buffer; ``offsets[i]:offsets[i + 1]`` is text i. Null texts are empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary()) if not pa.types.is_large_string(column.type) else column
        if column.null_count:
            column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        low, high = int(bounds[0]), int(bounds[-1])
        self.bytes = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
        self.offsets = bounds - low


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Row ranges of a batch with at most ``size`` bytes of text each (or one longer text)."""
    texts = batch.column(batch.schema.get_field_index(column))
    whole = Texts(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(whole.offsets, whole.offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        part = object.__new__(Texts)
        part.bytes = whole.bytes[whole.offsets[start] : whole.offsets[stop]]
        part.offsets = whole.offsets[start : stop + 1] - whole.offsets[start]
        yield start, stop, part
        start = stop


class Words:
    """Words are runs of bytes marked in ``is_word``; ``bounds[i]:bounds[i + 1]`` are the words of text i."""

    def __init__(self, texts: Texts, is_word: np.ndarray, lower: bool = False):
        data = LOWER[texts.bytes] if lower else texts.bytes
        n = len(data)
        self.data = np.zeros(n + 8, dtype=np.uint8)
        self.data[:n] = data
        marked = is_word[data]
        inside = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
        edge = np.ones(n + 1, dtype=bool)
        edge[1:n] = marked[1:] != marked[:-1]
        edge[inside] = True
        at = np.flatnonzero(edge) if n else np.zeros(1, dtype=np.int64)
        keep = marked[at[:-1]] if n else np.zeros(0, dtype=bool)
        self.starts, self.ends = at[:-1][keep], at[1:][keep]
        self.bounds = np.searchsorted(self.starts, texts.offsets)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, seed)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; ``data`` has 8 bytes more than its text."""
    lengths = ends - starts
    out = np.full(len(lengths), seed, dtype=np.uint64) ^ (lengths.astype(np.uint64) * _K3)
    if not len(lengths):
        return out
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    at, left, who = starts, lengths, np.arange(len(lengths))
    many = lengths > LONG_WORD
    if many.any():
        for i in np.flatnonzero(many):
            out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed & 0xFFFFFFFF)
        who = np.flatnonzero(~many)
        at, left = at[who], left[who]
    first = True
    while len(who):
        part = eight[at] & _MASKS[np.minimum(left, 8)]
        out[who] = mixed((out[who] if first else out[who] * _K1) ^ part)
        first = False
        more = left > 8
        who, at, left = who[more], at[more] + 8, left[more] - 8
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, also of those that cross texts."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = total * _K1 + hashes[i : i + n]
    return mixed(total)


def inner_windows(n_words: int, bounds: np.ndarray, size: int) -> np.ndarray:
    """The words at which a run of ``size`` words of one text starts."""
    n = max(0, n_words - size + 1)
    ok = np.ones(n, dtype=bool)
    for e in range(1, size):
        cut = bounds[1:-1] - e
        ok[cut[(cut >= 0) & (cut < n)]] = False
    return np.flatnonzero(ok)
