"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Vectors become whole numbers: each component x is floor(256 x). The score of two vectors is their integer inner product. An anchor's
positives are the rows of its label with the highest scores; a positive with score p opens a window of scores, from ``low`` to
``high`` percent of p, and the negatives are the highest rows of other labels inside it. Equal scores go by the smaller id.

Rows are cut into blocks of one label, by ranges of (label, id). A block stores its vectors and, for each dimension, the order of its rows
by that component. Anchors are gathered in blocks too, and each of them meets the blocks of its own label for the positives
and those of other labels for the negatives, block by block. Inside a block the threshold algorithm runs for each anchor: every list is read
from the end that the sign of the anchor's component prefers, to a depth that doubles; each row met is scored at once from its
whole vector; the threshold is the score of a row that would stand at the present depth in every list. Reading stops once the threshold is
strictly below the k-th score of each window (or below all that the window takes), so no row that could still enter it is unseen. The
best of all blocks are merged by rank.

Defined results: rows with a null id, label or vector or with a component that isn't a finite number take no part; equal rows count once; rows that
share the anchor's id are never its partners; a vector that is shorter than another has zeros in the places it lacks; components are clipped
at 2**26 in size, so that sums of up to 1024 of their products fit 63 bits; a window without rows gives none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajspark.llm.common import saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
LARGEST = 1 << 26
BLOCK_BYTES = 4 << 20
ANCHOR_BYTES = 1 << 18
FIRST_DEPTH = 16
_BLOCK = "block long, label {kind}, ids array<long>, keys array<long>, dims int, vectors binary, orders binary"


def quantised(rows: DataFrame, id_col: str, vector_col: str, label) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, each once."""
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    finite = F.forall(F.col(vector_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)
    own = own.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), whole.cast("array<int>").alias("vector"))
    return own.filter("label is not null").distinct().withColumn("key", F.xxhash64("label", "vector"))


def blocks_of(rows: DataFrame, n: int, dims: int, block_bytes: int, with_orders: bool, extra: str | None = None) -> DataFrame:
    """Blocks of one label each, of at most about ``block_bytes`` of vectors. ``extra`` names a column of lists that the blocks carry along."""
    size = max(1, block_bytes // (8 * dims))
    kind = rows.schema["label"].dataType.simpleString()
    ordered = rows.repartitionByRange(n // size + 1, "label", "vec_id", "key").sortWithinPartitions("label", "vec_id", "key")
    names = ["label", "vec_id", "key", "vector", *([extra] if extra else [])]

    def flushed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        (labels,) = table.column("label").chunks
        label = labels.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]])).tolist() + [len(label)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield _block(table.slice(low, high - low).combine_chunks(), dims, with_orders, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - rows_held)
                held.append(part)
                rows_held += part.num_rows
                at += part.num_rows
                if rows_held == size:
                    yield from flushed(held)
                    held, rows_held = [], 0
        if held:
            yield from flushed(held)

    more = f", {extra} array<array<array<long>>>" if extra else ""
    found = ordered.select(*names).mapInArrow(run, _BLOCK.format(kind=kind) + more)
    label = "anchors" if extra else "vectors"
    return saved(found.withColumn("block", F.monotonically_increasing_id()), f"negatives-{label}")


def _block(rows: pa.Table, dims: int, with_orders: bool, extra: str | None) -> pa.RecordBatch:
    column = {c: rows.column(c).chunk(0) for c in rows.column_names}
    lists = column["vector"]
    lengths = np.asarray(lists.value_lengths())
    vectors = np.zeros((len(lists), dims))
    row = np.repeat(np.arange(len(lists)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    vectors[row, place] = np.asarray(lists.flatten())
    orders = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32) if with_orders else np.zeros(0, np.int32)
    one = np.array([0, len(lists)], dtype=np.int32)
    cells = [
        pa.array([0]), column["label"].slice(0, 1), pa.ListArray.from_arrays(one, column["vec_id"]), pa.ListArray.from_arrays(one, column["key"]),
        pa.array([dims], pa.int32()), pa.array([vectors.tobytes()], pa.binary()), pa.array([orders.tobytes()], pa.binary()),
    ]
    names = ["block", "label", "ids", "keys", "dims", "vectors", "orders"]
    if extra:
        cells.append(pa.ListArray.from_arrays(one, column[extra]))
        names.append(extra)
    return pa.record_batch(cells, names)


class Lists:
    """A block's vectors with its sorted lists, read from either end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, orders: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.largest = np.abs(vectors).max(initial=0)
        ranked = np.take_along_axis(vectors, orders.T, axis=0).T
        self.orders = np.stack([orders, orders[:, ::-1]])  # least first, greatest first
        self.values = np.stack([ranked, ranked[:, ::-1]])

    def search(self, anchor: np.ndarray, skip: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[np.ndarray]:
        """For each window (least, greatest score) the ``k`` best rows inside it, best first, as (row, score) columns."""
        n, dims = len(self.ids), len(anchor)
        exact = self.largest * np.abs(anchor).max() * dims < 2.0**53  # sums of doubles are whole numbers then
        whole = anchor if exact else anchor.astype(np.int64)
        end, each = (anchor > 0).astype(int), np.arange(dims)
        seen = np.zeros(n, dtype=bool)
        seen[skip] = True
        row, score, depth = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while depth < n and not seen.all():
            at = self.values[end, each, depth]  # a row unseen so far stands here or later in every list
            threshold = float(at @ anchor) if exact else int((at.astype(np.int64) * whole).sum())
            if self._settled(threshold, score, windows, k):
                break
            upto = min(n, max(FIRST_DEPTH, 2 * depth))
            met = np.zeros(n, dtype=bool)
            met[self.orders[end, each, depth:upto].ravel()] = True
            fresh, depth = np.flatnonzero(met & ~seen), upto
            seen |= met
            scores = self.vectors[fresh] @ whole if exact else self.vectors[fresh].astype(np.int64) @ whole
            row, score = np.append(row, fresh), np.append(score, scores.astype(np.int64))
        found = []
        for least, greatest in windows:
            inside = np.flatnonzero((score >= least) & (score <= greatest))
            best = inside[np.lexsort((self.ids[row[inside]], -score[inside]))[:k]]
            found.append(np.stack([row[best], score[best]], axis=1))
        return found

    @staticmethod
    def _settled(threshold: float, scores: np.ndarray, windows: list[tuple[float, float]], k: int) -> bool:
        for least, greatest in windows:
            if threshold < least:
                continue
            inside = scores[(scores >= least) & (scores <= greatest)]
            if len(inside) < k or threshold >= np.partition(inside, len(inside) - k)[len(inside) - k]:
                return False
        return True


def _meet(anchors: DataFrame, blocks: DataFrame, n_blocks: int, same_label: bool) -> DataFrame:
    """Each block of vectors beside the blocks of anchors that are to be compared with it; pairs are formed from block numbers alone."""
    chunk = F.pmod(F.xxhash64("block"), F.lit(n_blocks)).alias("chunk")
    asks = anchors.select(F.col("block").alias("anchors"), F.col("label").alias("anchor_label"))
    asks = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    same = F.col("anchor_label") == F.col("label")
    pairs = asks.join(blocks.select("block", "label", chunk), "chunk").filter(same if same_label else ~same).select("anchors", "block")
    told = [c for c in ("ids", "keys", "vectors", "windows") if c in anchors.columns]
    small = anchors.select(F.col("block").alias("anchors"), *[F.col(c).alias(f"anchor_{c}") for c in told])
    own = blocks.select("block", "ids", "vectors", "orders", "dims")
    return pairs.join(small, "anchors").join(own.hint("merge"), "block").drop("anchors")


def _searched(met: DataFrame, k: int, windows_of) -> DataFrame:
    """(anchor_id, key, place, partner, score, positive_id, positive_score): the best ``k`` of each window of each anchor in each block."""
    extra = "anchor_windows" in met.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, last = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
                dims = cell["dims"].as_py()
                ids = np.asarray(cell["ids"].values)
                if (name := cell["block"].as_py()) != last:
                    vectors = np.frombuffer(cell["vectors"].as_py()).reshape(len(ids), dims)
                    orders = np.frombuffer(cell["orders"].as_py(), dtype=np.int32).reshape(dims, len(ids))
                    lists, last = Lists(ids, vectors, orders), name
                anchor_ids, keys = np.asarray(cell["anchor_ids"].values), np.asarray(cell["anchor_keys"].values)
                anchors = np.frombuffer(cell["anchor_vectors"].as_py()).reshape(len(anchor_ids), dims)
                asked = cell["anchor_windows"].as_py() if extra else [None] * len(anchor_ids)
                yield _answers(lists, anchor_ids, keys, anchors, asked, k, windows_of)

    return met.mapInArrow(run, "anchor_id long, key long, place int, partner long, score long, positive_id long, positive_score long")


def _answers(lists: Lists, anchor_ids, keys, anchors, asked, k: int, windows_of) -> pa.RecordBatch:
    columns: list[list[np.ndarray]] = [[] for _ in range(7)]
    for a, (anchor_id, key) in enumerate(zip(anchor_ids.tolist(), keys.tolist(), strict=True)):
        windows, told = windows_of(asked[a])
        low, high = np.searchsorted(lists.ids, [anchor_id, anchor_id + 1])
        found = lists.search(anchors[a], np.arange(low, high), windows, k)
        for place, (rows, (positive_id, positive_score)) in enumerate(zip(found, told, strict=True)):
            n = len(rows)
            if not n:
                continue
            values = (np.full(n, anchor_id), np.full(n, key), np.full(n, place), lists.ids[rows[:, 0].astype(np.int64)], rows[:, 1],
                      np.full(n, positive_id), np.full(n, positive_score))
            for column, value in zip(columns, values, strict=True):
                column.append(value)
    names = ["anchor_id", "key", "place", "partner", "score", "positive_id", "positive_score"]
    kinds = [pa.int32() if n == "place" else pa.int64() for n in names]
    return pa.record_batch([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, kinds, strict=True)], names)


def _any_score(_) -> tuple[list, list]:
    return [(-np.inf, np.inf)], [(0, 0)]


def score_windows(low: int, high: int):
    """Windows of whole scores n with low p <= 100 n <= high p for each positive (id, score p)."""

    def windows(positives) -> tuple[list, list]:
        return [(-(-low * p // 100), high * p // 100) for _, p in positives], [tuple(x) for x in positives]

    return windows


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, label=None, is_anchor=None,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``label`` and ``is_anchor`` are columns over ``vectors`` and
    over its id (by default the label as it is, and every row)."""
    rows = saved(quantised(vectors, id_col, vector_col, F.col(label_col) if label is None else label), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    n, dims = size["n"], max(1, size["dims"] or 0)
    blocks = blocks_of(rows, n, dims, block_bytes, True)
    n_blocks = max(1, blocks.count())
    chosen = rows if is_anchor is None else rows.filter(is_anchor(F.col("vec_id")))
    n_anchors = chosen.count()
    anchors = blocks_of(chosen, n_anchors, dims, ANCHOR_BYTES, False)

    near = _searched(_meet(anchors, blocks, n_blocks, True), positives, _any_score)
    best = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "partner")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    found = near.groupBy("anchor_id", "key").agg(F.array_sort(F.collect_list(F.struct("place", "partner", "score"))).alias("found"))
    asked = found.select("anchor_id", F.col("key").alias("_key"), F.transform("found", lambda x: F.array(x["partner"], x["score"])).alias("windows"))
    ready = chosen.join(asked, (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("_key")))
    ready = saved(ready.select("label", "vec_id", "key", "vector", "windows"), "negatives-asked")
    anchors = blocks_of(ready, n_anchors, dims, ANCHOR_BYTES, False, "windows")

    far = _searched(_meet(anchors, blocks, n_blocks, False), negatives, score_windows(low, high))
    best = Window.partitionBy("anchor_id", "key", "place").orderBy(F.desc("score"), "partner")
    far = far.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return far.select(
        "anchor_id", "positive_id", "rank", F.col("partner").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
