"""Quality classifier by co-training of two views (Blum and Mitchell 1998).

A document is bad when a label says that its quality is 0 or that it is toxic. Two logistic models judge it from separate views: its text (hashed words
and beginnings of words, and the shape of the text) and its metadata (language, source, length). In each round both are fitted and score a new pool
of documents without labels, and each hands the documents that it is surest of, bad and good in the proportion of the labels, to the other as
pseudo-labelled rows. How far such rows can be trusted is measured for each view and class: among labelled documents that no model saw, of
those at least as sure, how many are right beyond chance; the square of that is the weight of the rows, what a label so reliable tells. At the end each view is calibrated on those
documents, and the calibrated views are added up as log-odds. All documents are scored by the result; those whose probability of
being good is below 0.6 are rejected.

What is fitted is bounded, and nothing else is: at most about ``label_rows`` labelled documents (four fifths fit, one calibrates) and a pool of about
``pool_rows`` documents a round, chosen by hashes of their ids before any feature is made. Both are small enough to be broadcast as ids, so the
corpus is never shuffled. Every document is scored whatever its size.

Defined results: null and empty texts are judged by length and metadata, null metadata is a value of its own; labels of one
document that disagree make it bad; of texts with one id the least is used for fitting; null labels don't count; without labels of both kinds every score is the share of the good
(1 without any labels) and everything is kept, unless all labels are bad; repeated rows are alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import saved
from trajspark.llm.words import ALPHANUMERIC, Texts, Words, chunks, mixed, release_memory, span_hashes

WORDS = 1 << 18  # hashed words; the shape features follow
BEGINNINGS = (4, 5)
SHAPES = 6
TEXT_SIZE = WORDS + SHAPES * 16
META_SIZE = 1 << 12
TOP_FEATURES = 1024
LABEL_ROWS = 12_500
POOL_ROWS = 20_000
GIVEN = 2_000  # pseudo-labelled rows that a view hands over in a round
ROUNDS = 2
SAMPLE_TASKS = 16  # tasks for tables of bounded size, however many partitions the corpus has
CHUNK = 1 << 19  # bytes of text whose features are made at once
LEAST_GOOD = 0.6  # documents whose probability of being good is below are rejected
FOLDS = 5  # one of so many parts of the labels calibrates
LEAST_G = 10.83  # chi-square with one degree of freedom at 0.001


# kinds of bytes whose share counts: capitals, marks, digits
_MARKS = np.zeros(256, dtype=np.uint8)
_MARKS[33:127] = 2
_MARKS[48:58] = 3
_MARKS[65:91] = 1
_MARKS[97:123] = 0


def _share(marked: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
    return (total[texts.offsets[1:]] - total[texts.offsets[:-1]]) / np.maximum(np.diff(texts.offsets), 1)


def _beginnings(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash of its first ``size`` bytes) of the words that are longer."""
    long = np.flatnonzero(words.ends - words.starts > size)
    return long, mixed(span_hashes(words.data, words.starts[long], words.starts[long] + size) + np.uint64(size))


def text_features(texts: Texts, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, distinct; only of the features that are marked in ``wanted``, when it is given."""
    n = len(texts.offsets) - 1
    words = Words(texts, ALPHANUMERIC, lower=True)
    hashes, counts, at = words.hashes(), np.diff(words.bounds), words.text_of
    narrow = np.uint32 if n * WORDS < 1 << 32 else np.uint64
    keys = at.astype(narrow) * narrow(WORDS)
    mask = np.uint64(WORDS - 1)
    own = np.unique(keys + (hashes & mask).astype(narrow))
    parts = [own]
    for size in BEGINNINGS:
        who, begun = _beginnings(words, size)
        parts.append(keys[who] + (begun & mask).astype(narrow))
    if wanted is not None:
        parts = [p[wanted[p & narrow(WORDS - 1)]] for p in parts]
    found = np.unique(np.concatenate(parts)).astype(np.int64)

    distinct = np.bincount((own // narrow(WORDS)).astype(np.int64), minlength=n)
    again = np.bincount(at[1:][(hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])], minlength=n)
    data, some = texts.bytes, np.maximum(counts, 1)
    shapes = (
        _share(_MARKS[data] == 1, texts) * 20, _share(_MARKS[data] == 2, texts) * 40, _share(_MARKS[data] == 3, texts) * 20,
        distinct / some * 15, again / some * 20, np.log2(counts + 1),
    )
    cells = [WORDS + 16 * i + np.clip(s, 0, 15).astype(np.int64) for i, s in enumerate(shapes)]
    text = np.concatenate([found // WORDS, *[np.arange(n)] * SHAPES])
    return text, np.concatenate([found % WORDS, *cells])


def meta_features(columns: list[pa.Array], n_chars: pa.Array) -> np.ndarray:
    """A row of features for each document: one for each column and one for the length on a logarithmic scale."""
    cells = []
    for i, column in enumerate(columns):
        texts = Texts(column.cast(pa.large_string()))
        data = np.concatenate([texts.bytes, np.zeros(8, np.uint8)])
        hashes = span_hashes(data, texts.offsets[:-1], texts.offsets[1:], i + 1)
        hashes[np.asarray(column.is_null())] = np.uint64(i)
        cells.append(mixed(hashes) & np.uint64(META_SIZE // 2 - 1))
    length = n_chars.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)
    cells.append(META_SIZE // 2 + np.where(length < 0, 0, 1 + 4 * np.log2(np.maximum(length, 0) + 1)).astype(np.int64))
    return np.stack([c.astype(np.int64) for c in cells], axis=1)


@dataclass
class View:
    """Weights of a view's features, and the scale and shift that calibrate its log-odds of being bad."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def score(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        return np.bincount(row, weights=self.weights[feature], minlength=rows) + self.bias


@dataclass
class Model:
    text: View
    meta: View
    prior: float  # log-odds of being bad
    handed: tuple = ()  # (round, view that gave, bad, rows, weight) of each exchange
    limit: float = float(np.log(1 / LEAST_GOOD - 1))  # documents with larger log-odds are rejected

    def bad_odds(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return text * self.text.scale + self.text.shift + meta * self.meta.scale + self.meta.shift - self.prior


def fit_logistic(rows: np.ndarray, bad: np.ndarray, ridge: float = 1.0, trust: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the bias; Newton steps over blocks of rows, each counted by its trust, with a ridge on the weights."""
    n, d = rows.shape
    trust = np.ones(n, dtype=np.float32) if trust is None else trust.astype(np.float32)
    weights = np.zeros(d + 1)
    keep = np.append(np.full(d, ridge), 1e-9 * n)
    for _ in range(12):
        slope, bend = keep * weights, np.diag(keep).astype(np.float32)
        for at in range(0, n, 2000):
            x = np.hstack([rows[at : at + 2000], np.ones((len(rows[at : at + 2000]), 1), np.float32)])
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            t = trust[at : at + 2000]
            slope += x.T @ (t * (p - bad[at : at + 2000]))
            bend += x.T @ (x * (t * p * (1 - p)).astype(np.float32)[:, None])
        step = np.linalg.solve(bend.astype(np.float64), slope)
        weights -= step
        if np.abs(step).max() < 1e-3:
            break
    return weights


def calibrate(scores: np.ndarray, bad: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Platt's scale and shift from a histogram: of ``count`` documents with a score, ``bad`` are bad."""
    scale, shift = 1.0, 0.0
    target = (bad + 0.5) / (count + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scale * scores + shift, -30, 30)))
        w = count * p * (1 - p)
        g = np.array([(count * (p - target) * scores).sum() + 1e-3 * (scale - 1), (count * (p - target)).sum()])
        h = np.array([[(w * scores * scores).sum() + 1e-3, (w * scores).sum()], [(w * scores).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        scale, shift = scale - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(scale, 0.0), float(shift)


def _features(own: DataFrame, n_meta: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Rows of ``_columns`` with the text replaced by its features and the metadata by theirs; of the hashed words only those ``wanted``.
    Columns that follow are kept."""
    kept = own.columns[3 + n_meta :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                row, feature = text_features(texts, wanted)
                order = np.argsort(row, kind="stable")
                row, feature = row[order], feature[order]
                bounds = pa.array(np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32))
                meta = meta_features(part.columns[3 : 3 + n_meta], part.column(2))
                lists = pa.array(np.arange(len(part) + 1, dtype=np.int32) * meta.shape[1])
                yield pa.record_batch(
                    [part.column(0), pa.ListArray.from_arrays(bounds, pa.array(feature.astype(np.int32))),
                     pa.ListArray.from_arrays(lists, pa.array(meta.ravel().astype(np.int32))), *part.columns[3 + n_meta :]],
                    ["doc_id", "text", "meta", *kept])
        release_memory()

    more = "".join(f", {c} {own.schema[c].dataType.simpleString()}" for c in kept)
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text array<int>, meta array<int>{more}")


def _columns(docs: DataFrame, id_col: str, text_col: str, meta_cols: list[str], length_col: str) -> DataFrame:
    extra = [F.col(c).cast("string").alias(f"meta_{i}") for i, c in enumerate(meta_cols)]
    length = F.col(length_col).cast("long").alias("n_chars")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), length, *extra)


def _one_a_document(own: DataFrame, *more: str) -> DataFrame:
    """The least row of each id; copies are merged before the shuffle."""
    cells = [c for c in own.columns if c not in ("doc_id", *more)]
    least = own.groupBy("doc_id", *more).agg(F.min(F.struct(*cells)).alias("row")).coalesce(SAMPLE_TASKS)
    return least.select("doc_id", *[F.col("row")[c].alias(c) for c in cells], *more)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for start, stop, texts in chunks(batch, "text", CHUNK):
        yield batch.slice(start, stop - start), texts


def _counts(rows: DataFrame, view: str, size: int) -> DataFrame:
    """(feature, n, n_bad) over all rows of (bad, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), dtype=np.int64)
        for batch in batches:
            lists = batch.column(1)
            bad = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(bool), np.asarray(lists.value_lengths()))
            feature = np.asarray(lists.flatten())
            counts[0] += np.bincount(feature, minlength=size)
            counts[1] += np.bincount(feature[bad], minlength=size)
        used = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], ["feature", "n", "n_bad"])

    return rows.select("bad", view).mapInArrow(run, "feature long, n long, n_bad long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))


def _told(n: Column, n_bad: Column, all_: int, bad: int) -> Column:
    """Log-likelihood ratio of a feature's 2x2 table."""

    def part(k: Column, of: Column) -> Column:
        return F.when(k > 0, k * F.log(k / of)).otherwise(0.0)

    good = F.lit(float(all_ - bad))
    return 2 * (
        part(n_bad, n * bad / all_) + part(n - n_bad, n * good / all_) + part(bad - n_bad, (all_ - n) * bad / all_)
        + part(good - (n - n_bad), (all_ - n) * good / all_))


def _chosen(labelled: DataFrame, n: int, bad: int, view: str, size: int, top: int) -> list[int]:
    """The features that tell most about the labelled rows, by counts over all of them."""
    told = _told(F.col("n").cast("double"), F.col("n_bad").cast("double"), n, bad)
    found = _counts(labelled, view, size).select("feature", told.alias("told")).filter(F.col("told") > LEAST_G)
    return sorted(r["feature"] for r in found.orderBy(F.desc("told"), "feature").limit(top).collect())


def _fit(labelled: DataFrame, pseudo: list[DataFrame], prior: float, view: str, size: int, chosen: list[int]) -> View:
    """A view fitted on the labelled rows and on those that the other view handed over (bounded, see ``train``)."""
    if not chosen:
        return View(np.zeros(size, np.float32), prior)
    column = np.full(size, -1, dtype=np.int32)
    column[chosen] = np.arange(len(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            cells = column[np.asarray(lists.flatten())]
            row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))[cells >= 0]
            bounds = np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(bounds), pa.array(cells[cells >= 0]))], ["bad", "trust", "cells"])

    rows = [labelled.withColumn("trust", F.lit(1.0)), *pseudo]
    taken = [r for part in rows for r in part.select("bad", "trust", view).mapInArrow(run, "bad boolean, trust double, cells array<int>").collect()]
    matrix, bad, trust = np.zeros((len(taken), len(chosen)), dtype=np.float32), np.zeros(len(taken)), np.zeros(len(taken))
    for i, r in enumerate(taken):
        matrix[i, r["cells"]] = 1
        bad[i], trust[i] = r["bad"], r["trust"]
    if not len(bad) or bad.min() == bad.max():
        return View(np.zeros(size, np.float32), prior)
    found = fit_logistic(matrix, bad, trust=trust)
    weights = np.zeros(size, dtype=np.float32)
    weights[chosen] = found[:-1]
    return View(weights, float(found[-1]))


def _scored(features: DataFrame, text: View, meta: View) -> DataFrame:
    """All columns of ``features`` with the raw score of each view."""
    views = features.sparkSession.sparkContext.broadcast((text, meta))
    at = [features.columns.index(c) for c in ("text", "meta")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for view, column in zip(views.value, at, strict=True):
                lists = batch.column(column)
                row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
                scores.append(pa.array(view.score(row, np.asarray(lists.flatten()), len(lists))))
            yield pa.record_batch([*batch.columns, *scores], [*batch.schema.names, "text_score", "meta_score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in features.schema)
    return features.mapInArrow(run, f"{schema}, text_score double, meta_score double")


def _calibrated(held: DataFrame, text: View, meta: View) -> None:
    """Set scale and shift of both views from the labelled rows kept apart."""
    scored = _scored(held.select("bad", "text", "meta"), text, meta)
    for view, name in ((text, "text_score"), (meta, "meta_score")):
        bins = F.round(F.greatest(F.least(F.col(name), F.lit(25.0)), F.lit(-25.0)), 1).alias("score")
        rows = scored.groupBy(bins).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("int")).alias("bad")).collect()  # 501 at most
        if rows:
            view.scale, view.shift = calibrate(*(np.array([r[c] for r in rows], dtype=float) for c in ("score", "bad", "n")))


def _sampled(rows: DataFrame, n: int, wanted: int, turn: int, salt: str) -> DataFrame:
    """The part ``turn`` of rows dealt by a hash of the id into parts of about ``wanted``, or all of them when there are no more."""
    if n <= wanted:
        return rows if turn == 0 else rows.limit(0)
    width = int((1 << 30) * wanted / n)
    place = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30))
    return rows.filter((place >= turn * width) & (place < (turn + 1) * width))


def _pool(own: DataFrame, judged: DataFrame, n_docs: int, pool_rows: int, turn: int, rounds: int, n_meta: int, wanted: np.ndarray) -> DataFrame:
    """Features of one round's documents without labels. Their ids are bounded, so the labels among them are found without shuffling the labels."""
    part = _sampled(own.filter("doc_id is not null"), n_docs, min(pool_rows, max(1, n_docs // rounds)), turn, "pool")
    rows = saved(_features(_one_a_document(part), n_meta, wanted), "quality-pool")
    known = judged.join(F.broadcast(rows.select("doc_id")), "doc_id", "left_semi").select("doc_id")
    return rows.join(F.broadcast(known), "doc_id", "left_anti")


def _reliable(held: np.ndarray, bad: np.ndarray, limit: float, wanted: bool) -> float:
    """What a label of documents at least as sure as ``limit`` is worth, from 0 (chance) to 1 (always right).

    Of the held documents as sure as that, the share that is right, less two standard errors, is set against chance; its square is how much such
    a label tells compared with a true one.
    """
    sure = held >= limit if wanted else held <= limit
    right, n = (bad if wanted else ~bad), int(sure.sum())
    if not n:
        return 0.0
    chance, share = float(right.mean()), float(right[sure].mean())
    least = (share + 2 / n - 2 * math.sqrt(share * (1 - share) / n + 1 / n**2)) / (1 + 4 / n)
    return max(0.0, (least - chance) / max(1 - chance, 1e-9)) ** 2


def _surest(scored: DataFrame, score: str, n_bad: int, n_good: int) -> list[tuple[bool, DataFrame, float]]:
    """(bad, rows, score of the least sure of them) of the rows at both ends of a view's scores."""
    found = []
    for bad, n in ((True, n_bad), (False, n_good)):
        order = [F.desc(score) if bad else F.asc(score), F.asc("doc_id")]
        rows = saved(scored.orderBy(*order).limit(n).withColumn("bad", F.lit(bad)), "quality-given")
        edge = rows.agg((F.min(score) if bad else F.max(score)).alias("s")).first()["s"]
        found.append((bad, rows, float("nan") if edge is None else edge))
    return found


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ("lang", "source"),
    length_col: str = "n_chars", *, rounds: int = ROUNDS, given: int = GIVEN, top: int = TOP_FEATURES, label_rows: int = LABEL_ROWS,
    pool_rows: int = POOL_ROWS,
) -> Model:
    """Co-train on the labels (doc_id, quality, toxic) and on documents without labels; see the bounds above."""
    judged = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("bad"),
        F.max((F.col("quality").isNotNull() | F.col("toxic").isNotNull()).cast("int")).alias("known")).filter("known = 1")
    judged = saved(judged.select("doc_id", (F.col("bad") == 1).alias("bad")), "quality-labels")
    own, n_meta = _columns(docs, id_col, text_col, list(meta_cols), length_col), len(meta_cols)
    fitted = _sampled(judged, judged.count(), label_rows, 0, "label")
    marked = _one_a_document(own.join(F.broadcast(fitted), "doc_id"), "bad")
    marked = _features(marked.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0), n_meta)
    marked = saved(marked, "quality-labelled")
    seen = marked.groupBy("held").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("int")).alias("bad")).collect()
    n, bad = sum(r["n"] for r in seen), sum(r["bad"] for r in seen)
    labelled, held = marked.filter("not held").select("doc_id", "text", "meta", "bad"), marked.filter("held")
    mine = next(((r["n"], r["bad"]) for r in seen if not r["held"]), (0, 0))
    if not 0 < mine[1] < mine[0]:
        odds = float(np.log(bad / (n - bad))) if 0 < bad < n else (30.0 if n and bad == n else -30.0)
        flat = [View(np.zeros(s, np.float32), odds) for s in (TEXT_SIZE, META_SIZE)]
        return Model(*flat, odds, limit=float("-inf") if n and bad == n else float("inf"))
    prior = float(np.log(bad / (n - bad)))
    chosen = {view: _chosen(labelled, *mine, view, size, top) for view, size in (("text", TEXT_SIZE), ("meta", META_SIZE))}
    wanted = np.zeros(WORDS, dtype=bool)
    wanted[[f for f in chosen["text"] if f < WORDS]] = True
    n_docs, handed = docs.count(), []
    pseudo: dict[str, list[DataFrame]] = {"text": [], "meta": []}
    for turn in range(rounds + 1):
        text = _fit(labelled, pseudo["text"], prior, "text", TEXT_SIZE, chosen["text"])
        meta = _fit(labelled, pseudo["meta"], prior, "meta", META_SIZE, chosen["meta"])
        _calibrated(held, text, meta)
        if turn == rounds:
            break
        kept = _scored(held.select("bad", "text", "meta"), text, meta).select("bad", "text_score", "meta_score").collect()  # a fifth of label_rows
        wrong = np.array([r["bad"] for r in kept], dtype=bool)
        scored = saved(_scored(_pool(own, judged, n_docs, pool_rows, turn, rounds, n_meta, wanted), text, meta), "quality-scored")
        room = min(given, scored.count() // 2)
        n_bad = min(max(1, round(room * bad / n)), room)
        for view, other in (("text", "meta"), ("meta", "text")):
            for is_bad, rows, edge in _surest(scored, f"{view}_score", n_bad, room - n_bad):
                trust = _reliable(np.array([r[f"{view}_score"] for r in kept]), wrong, edge, is_bad)
                pseudo[other].append(rows.withColumn("trust", F.lit(trust)))
                handed.append((turn, view, is_bad, n_bad if is_bad else room - n_bad, trust))
    return Model(text, meta, prior, tuple(handed))


def _judge(model: Model, part: pa.RecordBatch, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-odds of being bad by text, by metadata, by both) of the rows of ``_columns``."""
    row, feature = text_features(texts, model.text.weights[:WORDS] != 0)
    length = part.schema.names.index("n_chars")  # the metadata follow
    meta = meta_features(part.columns[length + 1 :], part.column(length))
    text_score = model.text.score(row, feature, len(part))
    meta_score = model.meta.score(np.repeat(np.arange(len(part)), meta.shape[1]), meta.ravel(), len(part))
    both = model.bad_odds(text_score, meta_score)
    return text_score * model.text.scale + model.text.shift, meta_score * model.meta.scale + model.meta.shift, both


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ("lang", "source"),
    length_col: str = "n_chars",
) -> DataFrame:
    """One row per document: doc_id, text_score, meta_score, score (probabilities of being good), kept."""
    own = _columns(docs, id_col, text_col, list(meta_cols), length_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                odds = [np.clip(o, -500, 500) for o in _judge(shared.value, part, texts)]
                good = [pa.array(1 / (1 + np.exp(o))) for o in odds]
                yield pa.record_batch([part.column(0), *good, pa.array(odds[2] <= shared.value.limit)], ["doc_id", "text_score", "meta_score", "score", "kept"])
        release_memory()

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, text_score double, meta_score double, score double, kept boolean")


def keep_good(
    docs: DataFrame, model: Model, text_col: str = "text", meta_cols: tuple[str, ...] = ("lang", "source"), length_col: str = "n_chars"
) -> DataFrame:
    """The documents that the model keeps, with all their columns; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = dict(zip(batch.schema.names, batch.columns, strict=True))
            seen = pa.record_batch(
                [cell[text_col].cast(pa.string()), cell[length_col].cast(pa.int64()), *(cell[c].cast(pa.string()) for c in meta_cols)],
                ["text", "n_chars", *(f"meta_{i}" for i in range(len(meta_cols)))])
            kept = [_judge(shared.value, part, texts)[2] <= shared.value.limit for part, texts in _parts(seen)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
