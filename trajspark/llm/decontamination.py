"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document. Each segment holds some whole documents (about 4 MB of text): its terms as sorted 64-bit hashes, how often
each occurs, and the positions of all occurrences, term by term. Positions run on from document to document with a gap
that no phrase spans. The index is written to the shared folder and serves any number of benchmarks.

A search takes the benchmark's phrases in blocks of bounded size (a pass over the index each) and reads the index; nothing is shuffled, and a common term costs no more than
its postings in each segment. Inside a segment a phrase starts from the postings of its rarest term, moved back by the term's
offset, and is intersected with the postings of its other terms by rising frequency. With ``slop`` above 0 a term may
stand up to that many words from its place (proximity matches).

A phrase is ``size`` consecutive words of an item; an item with fewer words is one phrase. Words are runs of 0-9, a-z and
everything beyond ASCII, after lower-casing A-Z.

Defined results: null texts have no words; an item without words occurs nowhere; a null item id is the empty string in the
digest; items repeated with one id count once; an empty table gives no rows, an empty benchmark no hits; repeated documents are judged each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import saved, text_digest, unused
from trajspark.llm.words import ALPHANUMERIC, Texts, Words, chunks, release_memory

PHRASE = 10
SEGMENT_BYTES = 4 << 20
GAP = 1024
BLOCK_WORDS = 500_000
_SEGMENT = (
    "segment string, doc_ids array<{kind}>, n_words array<int>, starts array<int>, terms binary, counts binary, positions binary"
)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored index, one row per segment."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text", segment_bytes):
                yield _segment(batch.column(0).slice(start, stop - start), texts)
        release_memory()

    rows = own.mapInArrow(run, _SEGMENT.format(kind=kind)).withColumn("segment", F.expr("uuid()"))
    return saved(rows, "positional-index")


def _segment(ids: pa.Array, texts: Texts) -> pa.RecordBatch:
    words = Words(texts, ALPHANUMERIC, lower=True)
    hashes = words.hashes()
    positions = np.arange(len(hashes)) + words.text_of * GAP
    order = np.argsort(hashes, kind="stable")
    grouped = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]])) if len(grouped) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(grouped)))
    starts = words.bounds[:-1] + np.arange(len(ids)) * GAP
    cells = [
        pa.array([""]), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([np.diff(words.bounds).astype(np.int32)]),
        pa.array([starts.astype(np.int32)]),
        *(pa.array([a.tobytes()], pa.binary()) for a in (grouped[first], counts.astype(np.int32), positions[order].astype(np.int32))),
    ]
    return pa.record_batch(cells, ["segment", "doc_ids", "n_words", "starts", "terms", "counts", "positions"])


@dataclass
class Phrases:
    """Distinct phrases of a block of items: ``terms`` are the sorted hashes of their words, a row of ``grid`` indexes a phrase's words
    (-1 beyond its end), and ``items[owner[i]:owner[i + 1]]`` are the items that phrase i occurs in."""

    terms: np.ndarray
    grid: np.ndarray
    owner: np.ndarray
    items: np.ndarray
    names: list


def phrases_of(items: list[tuple[str, str | None]], size: int) -> Phrases:
    words = Words(Texts(pa.array([t for _, t in items], pa.large_string())), ALPHANUMERIC, lower=True)
    terms, codes = np.unique(words.hashes(), return_inverse=True)
    counts = np.diff(words.bounds)
    each = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    item = np.repeat(np.arange(len(items)), each)
    begin = np.repeat(words.bounds[:-1], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    place = begin[:, None] + np.arange(size)[None, :]
    inside = place < np.repeat(words.bounds[1:], each)[:, None]
    grid = np.where(inside, codes[np.minimum(place, len(codes) - 1)], -1) if len(codes) else np.zeros((0, size), np.int64)
    grid, which = np.unique(grid, axis=0, return_inverse=True) if len(grid) else (grid, np.zeros(0, np.int64))
    pairs = np.unique(np.stack([which.ravel(), item], axis=1), axis=0)
    owner = np.searchsorted(pairs[:, 0], np.arange(len(grid) + 1))
    return Phrases(terms, grid.astype(np.int32), owner, pairs[:, 1], [n for n, _ in items])


def find_phrases(terms, counts, positions, phrases: Phrases, slop: int) -> Iterator[tuple[int, np.ndarray]]:
    """(phrase, positions of its matched words as a matrix with one row per occurrence) in one segment."""
    if not len(terms) or not len(phrases.grid):
        return
    ends = np.cumsum(counts, dtype=np.int64)
    at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
    here = terms[at] == phrases.terms
    often = np.where(here, counts[at], 0)
    possible = ((phrases.grid < 0) | here[phrases.grid]).all(axis=1)
    begin = ends - counts
    for p in np.flatnonzero(possible):
        row = phrases.grid[p]
        row = row[row >= 0]
        rising = np.argsort(often[row], kind="stable").tolist()
        first, place = rising[0], at[row].tolist()
        found = positions[begin[place[first]] : ends[place[first]]].astype(np.int64) - first
        matched = found[:, None] + np.arange(len(row))
        for offset in rising[1:]:
            postings = positions[begin[place[offset]] : ends[place[offset]]]
            if slop:
                near = _nearest(postings.astype(np.int64), found + offset)
                matched[:, offset] = near
                good = np.abs(near - found - offset) <= slop
            else:
                wanted = found + offset
                good = postings[np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)] == wanted
            if not good.all():
                found, matched = found[good], matched[good]
                if not len(found):
                    break
        if len(found):
            yield int(p), matched


def _nearest(postings: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    right = np.searchsorted(postings, wanted)
    above = postings[np.minimum(right, len(postings) - 1)]
    below = postings[np.maximum(right - 1, 0)]
    return np.where(np.abs(above - wanted) <= np.abs(below - wanted), above, below)


def search_index(index: DataFrame, items: list[tuple[str, str | None]], size: int = PHRASE, slop: int = 0) -> DataFrame:
    """Per document of the index: segment, place in it, doc_id, n_words, ``hit`` (offsets of its hit words) and ``items``."""
    return _search(index, items, size, slop)[0]


def _search(index: DataFrame, items: list[tuple[str, str | None]], size: int, slop: int) -> tuple[DataFrame, Broadcast]:
    """The same with the broadcast phrases, for the caller to release."""
    if size + 2 * slop > GAP:
        raise ValueError(f"phrases may span at most {GAP} words")
    phrases = index.sparkSession.sparkContext.broadcast(phrases_of(items, size))
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _searched(batch.slice(i, 1), phrases.value, slop)

    schema = f"segment string, place int, doc_id {kind}, n_words int, hit array<int>, items array<string>"
    return index.mapInArrow(run, schema), phrases


def _searched(row: pa.RecordBatch, phrases: Phrases, slop: int) -> pa.RecordBatch:
    cell = {n: row.column(i)[0] for i, n in enumerate(row.schema.names)}
    terms, counts, positions = (
        np.frombuffer(cell[n].as_py(), dtype=d) for n, d in (("terms", np.uint64), ("counts", np.int32), ("positions", np.int32)))
    starts, n_words = np.asarray(cell["starts"].values), np.asarray(cell["n_words"].values)
    n = len(starts)
    hits, owners = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
    for p, matched in find_phrases(terms, counts, positions, phrases, slop):
        hits.append(np.unique(matched))
        docs = np.unique(np.searchsorted(starts, matched[:, 0], side="right") - 1)
        own = phrases.items[phrases.owner[p] : phrases.owner[p + 1]]
        owners.append(np.stack([np.repeat(docs, len(own)), np.tile(own, len(docs))], axis=1))
    hit = np.unique(np.concatenate(hits))
    of = np.searchsorted(starts, hit, side="right") - 1
    pairs = np.unique(np.concatenate(owners), axis=0)
    names = [phrases.names[i] for i in pairs[:, 1].tolist()]
    lists = [
        pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.arange(n + 1)), pa.int32()), values)
        for who, values in ((of, pa.array((hit - starts[of] if len(hit) else hit), pa.int32())), (pairs[:, 0], pa.array(names, pa.string())))
    ]
    return pa.record_batch(
        [pa.array([cell["segment"].as_py()] * n, pa.string()), pa.array(np.arange(n), pa.int32()), cell["doc_ids"].values,
         pa.array(n_words), *lists],
        ["segment", "place", "doc_id", "n_words", "hit", "items"],
    )


def _pieces(items: DataFrame, size: int, piece_words: int) -> DataFrame:
    """(item, text, n_words): items cut into pieces of at most ``piece_words`` words that overlap by a phrase less a word, so each phrase is
    in a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                words = Words(texts, ALPHANUMERIC, lower=True)
                names, parts, counts = [], [], []
                for i, item in enumerate(batch.column(0).slice(start, stop - start).to_pylist()):
                    at, end = int(words.bounds[i]), int(words.bounds[i + 1])
                    while at < end:
                        far = min(end, at + piece_words)
                        names.append(item)
                        parts.append(bytes(words.data[words.starts[at] : words.ends[far - 1]]).decode())
                        counts.append(far - at)
                        at = end if far == end else far - size + 1
                yield pa.record_batch([pa.array(names, pa.string()), pa.array(parts, pa.string()), pa.array(counts, pa.int64())], ["item", "text", "n_words"])

    return items.mapInArrow(run, "item string, text string, n_words long")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", *, size: int = PHRASE, slop: int = 0, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    The benchmark is cut into pieces by tasks and dealt into blocks of about ``block_words``. Each block is one pass over the index; its phrases
    are broadcast, its hits written and the broadcast released before the next, so the driver never holds more than a block.
    """
    index = build_index(docs, id_col, text_col)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text"))
    pieces = saved(_pieces(items, size, max(size, block_words // 16)), "benchmark-pieces")
    blocks = 1 + (pieces.agg(F.sum("n_words")).first()[0] or 0) // block_words
    if blocks == 1:
        rows, _ = _search(index, _phrases(pieces), size, slop)
    else:
        parts = []
        for number in range(blocks):
            dealt = pieces.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
            found, held = _search(index, _phrases(dealt), size, slop)
            parts.append(saved(found if number == 0 else found.filter("size(hit) > 0 or size(items) > 0"), f"hits-{number}"))
            held.unpersist(blocking=False)
        rows = functools.reduce(DataFrame.unionByName, parts).groupBy("segment", "place", "doc_id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"), F.flatten(F.collect_list("items")).alias("items"))
    names = F.array_sort(F.array_distinct("items"))
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hit").cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


def _phrases(block: DataFrame) -> list[tuple[str, str | None]]:
    """The items of one block, which is bounded."""
    return [(r["item"], r["text"]) for r in block.select("item", "text").collect()]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no phrase of the benchmark, with all their columns. Each row is judged by its own text, whatever its id."""
    digest, gone = unused("digest", docs), unused("gone", docs)
    named = docs.select(text_digest(F.col(text_col)).alias("name"), F.col(text_col).alias("text"))
    judged = contamination(named, benchmark, "name", "text", **options).filter("contaminated").select(F.col("doc_id").alias(gone)).distinct()
    judged = saved(judged, "contaminated")
    rows = docs.withColumn(digest, text_digest(F.col(text_col)))
    return rows.join(judged, F.col(digest) == F.col(gone), "left_anti").drop(digest)
