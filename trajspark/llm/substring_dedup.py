"""Substring deduplication on the de Bruijn graph of repeated word windows.

A window of 13 words is an edge from its first 12 words to its last 12. Only edges that occur in two documents or more form the graph. To
find them without shuffling every window, each window is represented by its minimizer, the 6 words among it with the
smallest hash; equal windows have equal minimizers, and neighbouring windows mostly share one. Windows whose minimizer occurs in one
document alone are never repeated; the others are counted by their own hash.

Paths: an edge and the one that follows it belong to one path when, over all occurrences, the first is followed by
no other repeated edge and the second preceded by no other. Edges that are neighbours in their first document are compacted there;
the pieces are then joined end to head by pointer doubling. The paths are returned with their lengths by ``repeated_paths``.

Spans: a window is removed when its smallest document has a smaller id than its own. Neighbouring removed windows on one path
whose sources are neighbours too are one span, with the coordinates of its source. A digest of the words of every span is compared
with the digest of the words at its source; if one differs (equal 64-bit hashes of different words) all is done again with another
seed, so the result is exact.

Copies and common passages: a document whose text (by SHA-256) a smaller one has loses all its words if they make a window, and takes
no further part; so a text that a third of the rows repeat counts once. For all others, occurrences of an edge are merged by grouped minima before the shuffle; joins of occurrences to edges
are splittable; windows over a document hold that document alone. Nothing is collected but two counts.

Defined results: a null text has no words; a row without an id keeps its words and is no source; rows repeated with one id don't
remove each other's words; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajspark.llm.common import discard, saved
from trajspark.llm.words import NOT_SPACE, Words, chunks, grams, inner_windows

WINDOW = 13
MINIMIZER = 6
ASKS = 1000


def minimized(words: Words, window: int, minimizer: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, window hashes, start of each window's minimizer, hash of it)."""
    hashes = words.hashes(seed)
    at = inner_windows(len(hashes), words.bounds, window)
    small = grams(hashes, minimizer)
    place = at.copy()
    best = small[at]
    for i in range(1, window - minimizer + 1):
        other = small[at + i]
        less = other < best
        best, place = np.where(less, other, best), np.where(less, at + i, place)
    return at, grams(hashes, window)[at], place, best


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def anchors(own: DataFrame, window: int, minimizer: int, seed: int) -> DataFrame:
    """(doc_id, place, anchor): the minimizers of each document, at their word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                words = Words(texts, NOT_SPACE)
                _, _, place, key = minimized(words, window, minimizer, seed)
                first = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
                place, key = place[first], key[first]
                text = np.searchsorted(words.bounds, place, side="right") - 1
                ids = batch.column(0).slice(start, stop - start).take(pa.array(text))
                yield pa.record_batch(
                    [ids, pa.array((place - words.bounds[text]).astype(np.int32)), pa.array(key.view(np.int64))], ["doc_id", "place", "anchor"])

    return own.filter("doc_id is not null").mapInArrow(run, f"doc_id {_kind(own)}, place int, anchor long")


def _kind(own: DataFrame) -> str:
    return own.schema["doc_id"].dataType.simpleString()


def whole_copies(own: DataFrame) -> DataFrame:
    """(doc_id) of the documents all of whose rows have the text of a document with a smaller id."""
    texts = saved(own.filter("doc_id IS NOT NULL").select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha")), "text-digests")
    first = texts.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    judged = texts.join(first, "sha", "left").withColumn("copied", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    return saved(judged.groupBy("doc_id").agg(F.min("copied").alias("copied")).filter("copied").select("doc_id"), "whole-copies")


def candidate_windows(own: DataFrame, copies: DataFrame, window: int, minimizer: int, seed: int) -> DataFrame:
    """(edge, doc_id, place) of the windows whose minimizer occurs in more than one document, without whole copies; written to the
    shared folder."""
    found = saved(anchors(own, window, minimizer, seed), "anchors")
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("anchor")
    shared = saved(shared, "anchors-shared")
    placed = found.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    places = saved(placed.join(copies, "doc_id", "left_anti"), "anchors-places")
    discard(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                words = Words(texts, NOT_SPACE)
                at, edge, place, _ = minimized(words, window, minimizer, seed)
                lists = batch.column(2).slice(start, stop - start)
                flat = np.asarray(lists.flatten()).astype(np.int64) + np.repeat(words.bounds[:-1], np.asarray(lists.value_lengths()))
                wanted = np.zeros(len(words.starts) + 1, dtype=bool)
                wanted[flat[flat < len(words.starts)]] = True
                good = wanted[place]
                at, edge = at[good], edge[good]
                text = np.searchsorted(words.bounds, at, side="right") - 1
                ids = batch.column(0).slice(start, stop - start).take(pa.array(text))
                yield pa.record_batch(
                    [pa.array(edge.view(np.int64)), ids, pa.array((at - words.bounds[text]).astype(np.int32))], ["edge", "doc_id", "place"])

    joined = own.join(places, "doc_id").select("doc_id", "text", "places")
    return saved(joined.mapInArrow(run, f"edge long, doc_id {_kind(own)}, place int"), "windows")


def repeated_edges(candidates: DataFrame) -> DataFrame:
    """Occurrences of the edges that more than one document has: (edge, doc_id, place, source), with the smallest document."""
    sources = candidates.groupBy("edge").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).filter("source < last")
    sources = saved(sources.select("edge", "source"), "edges")
    found = saved(candidates.join(sources, "edge"), "occurrences")
    discard(candidates)
    discard(sources)
    return found


def compacted(occurrences: DataFrame) -> DataFrame:
    """(edge, path, source, source_place): the nonbranching path of each edge and its first place in its smallest document."""
    order = Window.partitionBy("doc_id").orderBy("place", "edge")

    def beside(step: int):
        shift = F.lead if step > 0 else F.lag
        return F.when(shift("place").over(order) == F.col("place") + step, shift("edge").over(order))

    walked = occurrences.select("edge", "source", "doc_id", "place", beside(1).alias("after"), beside(-1).alias("before"))
    home = F.when(F.col("doc_id") == F.col("source"), F.col("place"))
    edges = saved(
        walked.groupBy("edge").agg(
            F.min("source").alias("source"), F.min(home).alias("source_place"), F.min("after").alias("after"), F.max("after").alias("after_2"),
            F.min("before").alias("before"), F.max("before").alias("before_2")),
        "edges-walked",
    )
    one_in = edges.filter("before = before_2").select(F.col("edge").alias("after"), F.lit(True).alias("joined"))
    linked = edges.join(one_in.withColumnRenamed("after", "_a"), (F.col("after") == F.col("_a")) & (F.col("after") == F.col("after_2")), "left")
    linked = linked.select("edge", "source", "source_place", F.when(F.col("joined"), F.col("after")).alias("next"))
    # pieces: neighbours in the smallest document
    run = Window.partitionBy("source").orderBy("source_place")
    goes_on = (F.lag("next").over(run) == F.col("edge")) & (F.lag("source_place").over(run) == F.col("source_place") - 1)
    marked = linked.withColumn("head", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("edge")))
    pieces = saved(
        marked.select("edge", "source", "source_place", "next", F.last("head", ignorenulls=True).over(run).alias("piece")), "pieces")
    return pieces.join(_joined_pieces(pieces), "piece", "left").select(
        "edge", F.coalesce("path", "piece").alias("path"), "source", "source_place")


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """(piece, path) of the pieces that continue another one, by pointer doubling towards the first piece of the path."""
    heads = pieces.filter("edge = piece").select(F.col("piece").alias("next"))
    tails = pieces.filter("next is not null").select(F.col("piece").alias("up"), "next")
    links = saved(tails.join(heads, "next").filter("up <> next").select(F.col("next").alias("piece"), F.col("up").alias("path")), "piece-links")
    rounds = max(1, links.count()).bit_length()  # a path of n pieces is whole after log2(n) doublings; so a ring ends too
    for _ in range(rounds):
        above = links.select(F.col("piece").alias("path"), F.col("path").alias("above"))
        jumped = saved(
            links.join(above, "path", "left").select("piece", F.coalesce("above", "path").alias("path"), F.col("above").isNotNull().alias("moved")),
            "piece-links")
        links = jumped.select("piece", "path")
        if not jumped.filter("moved").take(1):
            break
    return links


def repeated_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """(path, n_windows, source, source_place): compacted paths with the smallest source coordinate on them."""
    own = _texts(docs, id_col, text_col)
    nobody = own.select("doc_id").filter("false")
    found = compacted(repeated_edges(candidate_windows(own, nobody, window, minimizer, 0)))
    first = F.min(F.struct("source", "source_place"))
    return found.groupBy("path").agg(F.count(F.lit(1)).alias("n_windows"), first.alias("at")).select(
        "path", "n_windows", "at.source", "at.source_place")


def repeated_spans(occurrences: DataFrame, paths: DataFrame) -> DataFrame:
    """(doc_id, start, n, source, source_start): runs of n removed windows on one path, whose sources run along."""
    removed = occurrences.filter("doc_id > source").select("edge", "doc_id", "place")
    placed = removed.join(paths, "edge")
    order = Window.partitionBy("doc_id").orderBy("place")
    same = (
        (F.lag("place").over(order) == F.col("place") - 1) & (F.lag("path").over(order) == F.col("path"))
        & (F.lag("source").over(order) == F.col("source")) & (F.lag("source_place").over(order) == F.col("source_place") - 1)
    )
    start = F.when(F.coalesce(same, F.lit(False)), None).otherwise(F.struct(F.col("place").alias("start"), F.col("source_place").alias("source_start")))
    runs = placed.select("doc_id", "place", "source", start.alias("s"))
    runs = runs.withColumn("s", F.last("s", ignorenulls=True).over(order))
    return runs.groupBy("doc_id", "source", F.col("s.start").alias("start"), F.col("s.source_start").alias("source_start")).agg(
        F.countDistinct("place").cast("int").alias("n"))


_ANSWER = "doc_id {kind}, n_words long, n_removed long, kept_sha256 string, start int, n int, digest binary"


def _answers(own: DataFrame, spans: DataFrame, copies: DataFrame, window: int) -> DataFrame:
    """One pass over the texts: a row per document without its spans, and a row with the digest of each span or source asked for."""
    asked = spans.select(F.col("source").alias("doc_id"), F.col("source_start").alias("start"), "n").distinct()
    groups = asked.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / ASKS).cast("long").alias("parts"))
    asks = asked.join(groups, "doc_id").withColumn("part", F.pmod(F.xxhash64("start", "n"), F.col("parts")))
    cell = F.collect_list(F.struct("start", "n"))
    asks = asks.groupBy("doc_id", "part").agg(cell.alias("spans"))
    asks = asks.select("doc_id", F.lit(False).alias("whole"), F.lit(False).alias("copied"), "spans")
    mine = spans.groupBy("doc_id").agg(cell.alias("spans"))
    whole = own.select("doc_id").filter("doc_id is not null").distinct().join(mine, "doc_id", "left")
    whole = whole.join(copies.withColumn("copied", F.lit(True)), "doc_id", "left")
    whole = whole.select("doc_id", F.lit(True).alias("whole"), F.coalesce("copied", F.lit(False)).alias("copied"), "spans")
    work = own.join(whole.unionByName(asks), "doc_id").select("doc_id", "text", "whole", "copied", "spans")
    none = F.lit(None).cast(work.schema["spans"].dataType)
    nameless = own.filter("doc_id is null").select("doc_id", "text", F.lit(True).alias("whole"), F.lit(False).alias("copied"), none.alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                yield _answer(batch.slice(start, stop - start), Words(texts, NOT_SPACE), window)

    return work.unionByName(nameless).mapInArrow(run, _ANSWER.format(kind=_kind(own)))


def _answer(batch: pa.RecordBatch, words: Words, window: int) -> pa.RecordBatch:
    lengths = words.ends - words.starts
    to = np.cumsum(lengths + 1)
    begin = to - lengths - 1
    source = np.repeat(words.starts - begin, lengths + 1) + np.arange(int(to[-1]) if len(to) else 0)
    joined = words.data[source]
    joined[to - 1] = 32
    whole, copied = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)).astype(bool) for c in (2, 3))
    lists = batch.column(4)
    counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    flat = lists.flatten()
    starts, n = (np.asarray(flat.field(i)).astype(np.int64) for i in (0, 1))
    text = np.repeat(np.arange(len(batch)), counts)
    first = words.bounds[text] + starts
    last = first + n + window - 1
    inside = last <= words.bounds[text + 1]
    covered = np.zeros(len(lengths) + 1, dtype=np.int64)
    mine = inside & whole[text]
    np.add.at(covered, first[mine], 1)
    np.add.at(covered, last[mine], -1)
    gone = copied & (np.diff(words.bounds) >= window)
    np.add.at(covered, words.bounds[:-1][gone], 1)
    np.add.at(covered, words.bounds[1:][gone], -1)
    keep = np.cumsum(covered)[:-1] == 0
    kept = joined[np.repeat(keep, lengths + 1)].tobytes()
    ends = np.concatenate([[0], np.cumsum(np.where(keep, lengths + 1, 0))])[words.bounds]
    removed = np.concatenate([[0], np.cumsum(~keep)])[words.bounds]
    raw = joined.tobytes()
    digests = [
        hashlib.blake2b(raw[begin[a] : to[b - 1] - 1], digest_size=16).digest() if ok else b""
        for a, b, ok in zip(first.tolist(), last.tolist(), inside.tolist(), strict=True)
    ]
    rows = np.flatnonzero(whole)
    sums = [hashlib.sha256(kept[ends[i] : max(ends[i], ends[i + 1] - 1)]).hexdigest() for i in rows.tolist()]
    none = len(text)
    return pa.record_batch(
        [
            pa.concat_arrays([batch.column(0).take(pa.array(rows)), batch.column(0).take(pa.array(text))]),
            pa.array([*np.diff(words.bounds)[rows].tolist(), *[None] * none], pa.int64()),
            pa.array([*np.diff(removed)[rows].tolist(), *[None] * none], pa.int64()),
            pa.array([*sums, *[None] * none], pa.string()),
            pa.array([*[None] * len(rows), *starts.tolist()], pa.int32()),
            pa.array([*[None] * len(rows), *n.tolist()], pa.int32()),
            pa.array([*[None] * len(rows), *digests], pa.binary()),
        ],
        ["doc_id", "n_words", "n_removed", "kept_sha256", "start", "n", "digest"],
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, minimizer: int = MINIMIZER, seed: int = 0
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    own = _texts(docs, id_col, text_col)
    copies = whole_copies(own)
    while True:
        occurrences = repeated_edges(candidate_windows(own, copies, window, minimizer, seed))
        spans = saved(repeated_spans(occurrences, compacted(occurrences)), "spans")
        discard(occurrences)
        answers = saved(_answers(own, spans, copies, window), "answers")
        digests = saved(answers.filter("digest is not null").select("doc_id", "start", "n", "digest").distinct(), "digests")
        there = digests.select(F.col("doc_id").alias("source"), F.col("start").alias("source_start"), "n", F.col("digest").alias("there"))
        # spans of one source with one digest are one row before they meet it, so a passage that many documents share is compared once
        told = spans.join(digests, ["doc_id", "start", "n"]).groupBy("source", "source_start", "n", "digest").agg(F.count(F.lit(1)).alias("spans"))
        checked = told.join(there, ["source", "source_start", "n"]).filter("digest = there").agg(F.sum("spans")).first()[0] or 0
        if checked == spans.count():
            return answers.filter("n_words is not null").select("doc_id", "n_words", "n_removed", "kept_sha256")
        seed += 1
