"""Repeated byte windows by a radix sort of all suffixes that stops at the window length.

Every byte at which a whole window of ``length`` bytes starts is a suffix. Suffixes are ordered by digits of falling significance, one
pass a digit, and whatever is alone under its digits so far is left out of the next pass; suffixes that are equal through all
digits are the repeated windows. The first of a group, by (doc_id, start), stays and all others are repeats.

1. The first digit is a suffix's signature: the piece of ``length // 3`` bytes or less (a power of two) inside its window whose hash is
   least. Neighbouring suffixes mostly share one, so they travel as a *run*, some 35 suffixes a row, and the second digit is the whole run, the
   bytes from the first to the last window in it. Runs that are equal are equal suffix by suffix; all but the first are repeats. Runs that
   are alone under their signature are done.
2. What is left are different runs under one signature, at the edges of repeats. They are cut into pieces of ``PIECE`` suffixes, aligned at
   the signature, and the pass is repeated with the bytes that all windows of a piece share as the first digit and all bytes of the piece as the second.
3. The suffixes of the pieces left go on one by one, with their whole window as the last digit.

A pass is a range partitioning by (digits, source) and a sort inside the partitions, so a group of any size is spread over tasks and
each row needs only the row before it. Groups that cross a partition's edge simply stay open for the next pass; in the last one the ends of the
partitions are compared (a few numbers a partition). Digits are 64-bit hashes, two of them where suffixes are taken as equal.

Defined results: null texts are empty; rows alike in id and text are one document and each is returned; different texts under one id are
ordered by a hash of the text, null ids come first; texts shorter than a window lose nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import discard, saved
from trajspark.llm.words import Texts, mixed

LENGTH = 100
PIECE = 8
SLICE_BYTES = 1 << 18
ROWS_A_TASK = 400_000
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTES = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in _BASES]


ROW = ["k1", "k2", "doc_id", "own", "at", "n", "lead"]
MARK = ["doc_id", "own", "at", "n", "lead", "open"]


def _row_schema(rows: DataFrame) -> str:
    return f"k1 long, k2 long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, own long, at long, n int, lead int"


class Spans:
    """Hashes of spans of one buffer: sums of byte values times powers of an odd base, shifted back to the span's start."""

    def __init__(self, data: np.ndarray, which: int, powers: np.ndarray, inverse: np.ndarray):
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[which][data] * powers[: len(data)], out=self.total[1:])
        self.inverse = inverse

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, b, dtype=np.uint64)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def signature_bytes(length: int) -> int:
    return 1 << max(0, (length // 3).bit_length() - 1)


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, powers) -> tuple[np.ndarray, ...]:
    """(first suffix, suffixes, bytes to the signature, signature, digest) of all runs of the parts ``data[bounds[i]:bounds[i + 1]]``."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    size, own = 1, _BYTES[0][data]
    while size < signature_bytes(length):
        own = own[:-size] * np.uint64(_BASES[1] + 2 * size) + own[size:]
        size *= 2
    own = mixed(own)
    least = (own & _HIGH) | np.arange(len(own), dtype=np.uint64)
    width, done = length - size + 1, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    at = (least & _LOW).astype(np.int64)

    inside = np.ones(n, dtype=bool)
    for cut in bounds[1:-1].tolist():
        inside[max(0, cut - length + 1) : cut] = False
    first = np.flatnonzero(inside)
    if not len(first):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(first), dtype=bool)
    new[1:] = (at[first[1:]] != at[first[:-1]]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(first)))
    start = first[begin]
    return start, count, at[start] - start, own[at[start]], Spans(data, 1, *powers).hashes(start, start + count + length - 1)


def _slices(texts: Texts, length: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, offsets in their texts, bytes, bounds) of pieces of about ``size`` bytes; pieces of a longer text overlap by a window less a byte."""
    rows, offsets, parts, held = [], [], [], 0
    for i, (low, high) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)):
        for at in range(low, max(low + 1, high - length + 1), size):
            part = texts.bytes[at : min(at + size + length - 1, high)]
            if len(part) < length:
                continue
            rows.append(i)
            offsets.append(at - low)
            parts.append(part)
            held += len(part)
            if held >= size:
                yield np.array(rows), np.array(offsets), np.concatenate(parts), np.cumsum([0, *map(len, parts)])
                rows, offsets, parts, held = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(offsets), np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def suffix_runs(own: DataFrame, length: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(k1, k2, doc_id, own, at, n, lead): signature, digest, source, number of suffixes and bytes before the signature of every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(1, 2 * slice_bytes + 2 * length)
        for batch in batches:
            for rows, offsets, data, bounds in _slices(Texts(batch.column(2)), length, slice_bytes):
                start, count, lead, k1, k2 = runs_of(data, bounds, length, powers)
                piece = np.searchsorted(bounds, start, side="right") - 1
                of = pa.array(rows[piece])
                at = start - bounds[piece] + offsets[piece]
                yield pa.record_batch(
                    [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                     pa.array(at), pa.array(count.astype(np.int32)), pa.array(lead.astype(np.int32))], ROW)

    return own.mapInArrow(run, _row_schema(own))


def _ordered(rows: DataFrame, tasks: int) -> DataFrame:
    order = ["k1", "k2", "doc_id", "own", "at"]
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


class Groups:
    """Groups of equal (k1, k2) over the batches of one sorted partition."""

    def __init__(self):
        self.key = self.source = None

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(rows that begin a group, rows that repeat its first one from another place)."""
        k1, k2, own, at = (_column(batch, c) for c in ("k1", "k2", "own", "at"))
        new = np.ones(len(k1), dtype=bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        new[0] = self.key != (k1[0], k2[0])
        first = np.maximum.accumulate(np.where(new, np.arange(len(k1)), -1))
        held = self.source or (own[0], at[0])
        own_of = np.where(first >= 0, own[first], held[0])
        at_of = np.where(first >= 0, at[first], held[1])
        self.key, self.source = (k1[-1], k2[-1]), (own_of[-1], at_of[-1])
        return new, ~new & ((own != own_of) | (at != at_of))


def _marked_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated runs, and the open ones: first of their kind, but not known to be alone under their first digit."""

    def out(batch: pa.RecordBatch, rows: np.ndarray, still_open: bool) -> pa.RecordBatch:
        part = batch.select(MARK[:-1]).take(pa.array(rows))
        return pa.record_batch([*part.columns, pa.array([still_open] * len(part), pa.bool_())], MARK)

    groups, waiting, known, earliest = Groups(), None, True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        new, again = groups.read(batch)
        if again.any():
            yield out(batch, np.flatnonzero(again), False)
        begins = np.flatnonzero(new)
        if not len(begins):
            continue
        k1 = _column(batch, "k1")[begins]
        earliest = k1[0] if earliest is None else earliest
        same = np.zeros(len(k1) + 1, dtype=bool)  # as the group before
        same[1:-1] = k1[1:] == k1[:-1]
        if waiting is not None:
            same[0] = _column(waiting, "k1")[0] == k1[0]
            if known or same[0]:
                yield out(waiting, np.array([0]), True)
        is_open = same[:-1] | same[1:] | (k1 == earliest)
        waiting, known = batch.slice(int(begins[-1]), 1), bool(is_open[-1])
        if is_open[:-1].any():
            yield out(batch, begins[:-1][is_open[:-1]], True)
    if waiting is not None:
        yield out(waiting, np.array([0]), True)


def _marked_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated suffixes (part -1), and the first rows of the first and of the last group of partition p (parts 2p and 2p + 1)."""

    def out(batch: pa.RecordBatch, rows: np.ndarray, part: int) -> pa.RecordBatch:
        columns = batch.take(pa.array(rows)).columns
        return pa.record_batch([*columns, pa.array([part] * len(rows), pa.int32())], [*batch.schema.names, "part"])

    groups, last, part = Groups(), None, TaskContext.get().partitionId()
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = groups.key is None
        new, again = groups.read(batch)
        if again.any():
            yield out(batch, np.flatnonzero(again), -1)
        if fresh:
            yield out(batch, np.array([0]), 2 * part)
        if new.any():
            last = batch.slice(int(np.flatnonzero(new)[-1]), 1)
    if last is not None:
        yield out(last, np.array([0]), 2 * part + 1)


def _carried(edges: list, schema: str, spark) -> DataFrame:
    """Partitions' first rows whose group began in an earlier partition from another place."""
    key = source = None
    found = []
    edges = sorted(edges, key=lambda r: r["part"])
    for head, tail in zip(edges[::2], edges[1::2], strict=True):
        if (head["k1"], head["k2"]) == key and (head["own"], head["at"]) != source:
            found.append((head["doc_id"], head["own"], head["at"], 1))
        if (tail["k1"], tail["k2"]) != key:
            key, source = (tail["k1"], tail["k2"]), (tail["own"], tail["at"])
    return spark.createDataFrame(found, schema)


def _pieces(texts: DataFrame, length: int, step: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The open runs of each text cut into pieces of at most ``step`` suffixes, as rows like those of ``suffix_runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = 2 * slice_bytes + 4 * length
        tables = [_powers(which, room) for which in (0, 1)]
        for batch in batches:
            texts, spans = Texts(batch.column(2)), batch.column(3)
            bounds, flat = np.asarray(spans.offsets), spans.values
            own = slice(int(bounds[0]), int(bounds[-1]))
            at, n, lead = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64)[own] for f in ("at", "n", "lead"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            # piece number q of a run holds its suffixes with (bytes to the signature) // step == q
            high, low = lead // step, (lead - n + 1) // step
            each = high - low + 1
            which = np.repeat(np.arange(len(at)), each)
            q = high[which] - (np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each))
            first, last = np.minimum(lead[which], q * step + step - 1), np.maximum((lead - n + 1)[which], q * step)
            at, n, row, lead, least = at[which] + lead[which] - first, first - last + 1, row[which], first, q * step
            size = n + length - 1
            upto = np.cumsum(size)
            low = 0
            while low < len(at):
                before = upto[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(upto, before + slice_bytes, side="right")))
                part = slice(low, high)
                begin = upto[part] - size[part] - before
                inner = np.arange(int(size[part].sum())) - np.repeat(begin, size[part])
                data = texts.bytes[np.repeat(texts.offsets[row[part]] + at[part], size[part]) + inner]
                core = begin + lead[part] - least[part]  # what all windows of that number share, whether this piece has them all or not
                core = Spans(data, 0, *tables[0]).hashes(core, core + length - step + 1)
                whole = Spans(data, 1, *tables[1]).hashes(begin, begin + size[part])
                of = pa.array(row[part])
                yield pa.record_batch(
                    [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                     pa.array(at[part]), pa.array(n[part].astype(np.int32)), pa.array(lead[part].astype(np.int32))], ROW)
                low = high

    return texts.mapInArrow(run, _row_schema(texts))


def _pass(rows: DataFrame, marks, schema: str, label: str, rows_a_task: int) -> DataFrame:
    """One pass of the sort over written rows, whose files are deleted after it."""
    ordered = _ordered(rows, rows.count() // rows_a_task + 1)
    marked = saved(ordered.mapInArrow(marks, schema), label)
    discard(rows)
    return marked


def repeated_windows(own: DataFrame, length: int = LENGTH, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(doc_id, own, at, n): from byte ``at`` on ``n`` suffixes in a row of a document whose windows also start earlier."""
    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, own long, at long, n int, lead int, open boolean"
    marked = _pass(saved(suffix_runs(own, length), "suffix-runs"), _marked_runs, schema, "suffix-marked-runs", rows_a_task)
    pieces = saved(_pieces(_open_texts(own, marked), length, min(PIECE, length)), "suffix-pieces")
    finer = _pass(pieces, _marked_runs, schema, "suffix-marked-pieces", rows_a_task)
    single = saved(_pieces(_open_texts(own, finer), length, 1), "suffix-single")
    again = _pass(single, _marked_suffixes, f"{_row_schema(own)}, part int", "suffix-marked", rows_a_task)
    edges = again.filter("part >= 0").collect()  # two rows a partition
    source = f"doc_id {kind}, own long, at long, n int"
    found = [t.filter("not open") for t in (marked, finer)] + [again.filter("part < 0"), _carried(edges, source, own.sparkSession)]
    found = [t.select("doc_id", "own", "at", "n") for t in found]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def _open_texts(own: DataFrame, marked: DataFrame) -> DataFrame:
    spans = marked.filter("open").groupBy("doc_id", "own").agg(F.collect_list(F.struct("at", "n", "lead")).alias("spans"))
    return _with_spans(own, spans, "inner")


def _with_spans(own: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("own").alias("_own"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_own"))
    return own.join(spans, same, how).select("doc_id", "own", "text", "spans")


def kept_bytes(text: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> tuple[int, int, np.ndarray]:
    """(removed bytes, removed stretches, bytes that stay) when the windows of the given suffixes are removed."""
    change = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + n + length - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    begins = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return int(gone.sum()), begins, text[~gone]


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH, keep_text: bool = False,
    rows_a_task: int = ROWS_A_TASK,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` the bytes that stay as ``kept``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("own"), text.alias("text"))
    spans = repeated_windows(own, length, rows_a_task).groupBy("doc_id", "own").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = Texts(batch.column(2)), batch.column(3)
            rows = []
            for i in range(batch.num_rows):
                data = texts.bytes[texts.offsets[i] : texts.offsets[i + 1]]
                found = lists[i].values
                if found is None:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.tobytes() if keep_text else None))
                    continue
                at, n = (found.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("at", "n"))
                removed, stretches, kept = kept_bytes(data, at, n, length)
                rows.append((len(data), removed, stretches, hashlib.sha256(kept).hexdigest(), kept.tobytes() if keep_text else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", *names])

    names, kinds = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    found = _with_spans(own, spans, "left").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return found if keep_text else found.drop("kept")
