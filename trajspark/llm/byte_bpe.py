"""Byte-level BPE with a rank queue on a hierarchical bitmap.

A pre-token is a linked list of symbols. Every adjacent pair that merges waits in the bucket of its merge rank, as the list
position of its left symbol. A bitmap marks the buckets in use, 256 to a word, and a word above marks the words in use, and so on; find-first-set from
the top finds the lowest rank in a few steps. A pair whose symbols have merged otherwise since is stale and skipped. So n symbols take
about n log n steps however long the pre-token is. The new pre-tokens of a chunk share one queue, and a bucket merges in one sweep.

Texts are encoded and decoded inside the scan: no shuffle, memory bounded by a few MB of text (or the longest text) and the cache
of pre-tokens.

Defined results: a null text is empty and has no ids; repeated rows are alike; an empty table gives no rows; other columns are
ignored. Decoding gives back the bytes of the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.llm.pretokens import Encoder, Pretokens
from trajspark.llm.words import chunks, release_memory

WORD = 8  # 2**8 marks in a word of the bitmap


class RankMarks:
    """A hierarchical bitmap of ranks: ``add``, ``remove``, and the lowest rank by find-first-set on each level."""

    def __init__(self, ranks: int):
        self.levels = []
        while True:
            ranks = (ranks >> WORD) + 1
            self.levels.append([0] * ranks)
            if ranks == 1:
                break

    def add(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> WORD
            marked = level[word]
            level[word] = marked | 1 << (rank & 255)
            if marked:
                return
            rank = word

    def remove(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> WORD
            level[word] &= ~(1 << (rank & 255))
            if level[word]:
                return
            rank = word

    def lowest(self) -> int:
        rank = 0
        for level in reversed(self.levels):
            marks = level[rank]
            rank = rank << WORD | (marks & -marks).bit_length() - 1
        return rank


class ByteBpe:
    """``ranks`` maps token bytes to rank, which is also the id. All single bytes have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.none = max(ranks.values()) + 1  # the rank of a pair that doesn't merge
        self.tokens = [b""] * self.none
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.marks = RankMarks(self.none)
        lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.lengths, self.begin = lengths, np.cumsum(lengths) - lengths
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        pairs = sorted(
            (ranks[t[:i]] * self.none + ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [0], dtype=np.int64)
        byte = np.arange(256)
        self.byte_pairs = self.merged(np.repeat(self.single, 256), np.tile(self.single[byte], 256))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair of symbols merges to."""
        key = left * self.none + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (right < self.none), self.pair_ranks[at], self.none)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, one pair at a time: always the leftmost pair of the lowest rank."""
        ranks, tokens, marks = self.ranks, self.tokens, self.marks
        buckets: dict[int, list[int]] = {}

        def push(rank: int | None, position: int) -> None:
            if rank is not None:
                if rank not in buckets:
                    buckets[rank] = []
                    marks.add(rank)
                heappush(buckets[rank], position)

        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        symbols = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            push(ranks.get(piece[i : i + 2]), i)
        while buckets:
            rank = marks.lowest()
            i = heappop(buckets[rank])
            if not buckets[rank]:
                del buckets[rank]
                marks.remove(rank)
            j = after[i]
            if symbols[i] < 0 or j >= n or ranks.get(tokens[symbols[i]] + tokens[symbols[j]]) != rank:
                continue  # stale
            symbols[i], symbols[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                push(ranks.get(tokens[rank] + tokens[symbols[k]]), i)
            if before[i] >= 0:
                push(ranks.get(tokens[symbols[before[i]]] + tokens[rank]), before[i])
        return [s for s in symbols if s >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens one after another, how many each has).

        All pre-tokens wait in one queue, in one linked list that no pair crosses pre-tokens in; a popped bucket merges as a
        whole, of overlapping pairs the left one first. That is the same as one pair at a time unless a merge makes a pair of a
        lower rank than its own, which a trained vocabulary hardly has; such pre-tokens are encoded again pair by pair.
        """
        sizes = np.ones(len(pieces), dtype=np.int64)
        whole = [self.ranks.get(p, -1) for p in pieces]
        rest = [i for i, w in enumerate(whole) if w < 0]
        flat = np.array(whole, dtype=np.int64)
        if rest:
            ids, each = self._queue([pieces[i] for i in rest])
            sizes[rest] = each
            to = np.cumsum(sizes)
            out = np.empty(int(to[-1]), dtype=np.int64)
            out[np.repeat(flat >= 0, sizes)] = flat[flat >= 0]
            out[np.repeat(flat < 0, sizes)] = ids
            flat = out
        return flat.astype(np.uint32), sizes

    def _queue(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        none, marks = self.none, self.marks
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(data)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(lengths)
        symbols = np.append(self.single[data], none)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n  # n stands for no neighbour
        before[ends - lengths] = n
        rank_at = np.full(n + 1, none, dtype=np.int64)
        rank_at[: n - 1] = self.byte_pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
        rank_at[ends - 1] = none
        buckets: dict[int, list[np.ndarray]] = {}
        again: list[np.ndarray] = []

        def push(places: np.ndarray) -> None:
            ranks = rank_at[places]
            if len(places) > 1:
                order = np.argsort(ranks, kind="stable")
                places, ranks = places[order], ranks[order]
            stop = int(np.searchsorted(ranks, none))
            cuts = np.flatnonzero(ranks[1:stop] != ranks[: stop - 1]) + 1 if stop > 1 else ()
            begin = 0
            for end in (*cuts, stop):
                if end > begin:
                    rank = int(ranks[begin])
                    if rank in buckets:
                        buckets[rank].append(places[begin:end])
                    else:
                        buckets[rank] = [places[begin:end]]
                        marks.add(rank)
                begin = end

        push(np.flatnonzero(rank_at != none))
        while buckets:
            rank = marks.lowest()
            marks.remove(rank)
            parts = buckets.pop(rank)
            here = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            here = here[rank_at[here] == rank]  # the others are stale
            if not len(here):
                continue
            right = after[here]
            chained = right[:-1] == here[1:]
            if chained.any():
                head = np.flatnonzero(np.append(True, ~chained))
                turn = np.arange(len(here)) - np.repeat(head, np.diff(np.append(head, len(here))))
                here = here[turn % 2 == 0]
                right = after[here]
            beyond = after[right]
            side = np.flatnonzero(beyond[:-1] == here[1:])  # one by one, such a merge stands beside its neighbour's first symbol
            if len(side):
                early = self.merged(np.full(len(side), rank), symbols[beyond[side]])
                if (early < rank).any():
                    again.append(here[side[early < rank]])
            symbols[here], symbols[right] = rank, -1
            rank_at[right] = none
            after[here], before[beyond] = beyond, here
            left = before[here]
            changed = np.concatenate([here, left[left < n]])
            if len(here) > 1:
                changed = np.unique(changed)
            new = self.merged(symbols[changed], symbols[after[changed]])
            rank_at[changed] = new
            if (new < rank).any():
                again.append(changed[new < rank])
            push(changed)
        symbols = symbols[:n]
        alive = symbols >= 0
        each = np.add.reduceat(alive, ends - lengths, dtype=np.int64)
        ids = symbols[alive]
        if again:
            redo = np.unique(np.searchsorted(ends, np.concatenate(again), side="right"))
            lists = np.split(ids, np.cumsum(each)[:-1])
            for i in redo.tolist():
                lists[i] = np.array(self.encode_piece(pieces[i]), dtype=np.int64)
                each[i] = len(lists[i])
            ids = np.concatenate(lists)
        return ids, each

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after another, byte each id starts at, and the end)."""
        each = self.lengths[ids]
        to = np.cumsum(each)
        source = np.repeat(self.begin[ids] - (to - each), each)
        source += np.arange(len(source))
        return self.flat[source], np.concatenate([[0], to])


@cache
def load(path: str) -> ByteBpe:
    """Read a rank file, once per Python worker."""
    with open(path, "rb") as lines:
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(load(path).encode_pieces)


def encode_documents(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids as binary little-endian unsigned 32-bit numbers, decoded as binary), one row per document."""
    return _run(docs, rank_file, id_col, text_col, "ids binary, decoded binary", lambda ids, text: (ids.tobytes(), text.tobytes()))


def token_digests(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per document."""
    sha = lambda a: hashlib.sha256(a).hexdigest()
    return _run(docs, rank_file, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda ids, text: (len(ids), sha(ids), sha(text)))


def _run(docs: DataFrame, rank_file: str, id_col: str, text_col: str, columns: str, make) -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id"] + [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = load(rank_file), _encoder(rank_file)
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                ids, bounds = encoder.ids(Pretokens(texts))
                text, at = bpe.decode(ids)
                rows = [make(ids[a:b], text[at[a] : at[b]]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.record_batch([batch.column(0).slice(start, stop - start), *map(pa.array, zip(*rows, strict=True))], names)
        encoder.forget()
        release_memory()

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, {columns}")
