"""Token files: ids of documents in a Huffman-coded binary form, written and read back by Spark.

A token folder holds
  ``blocks``  rows of the tokenizer's output in ascending id order: part, block, the ids' offset in their part, doc_ids, lengths, ids;
              this is the work copy that the code is counted from
  ``code``    (symbol, bits) of the canonical length-limited Huffman code, from the counts over all documents
  ``files``   the blocks with their ids as Huffman payload and the bit offset of every 128th id. Each row decodes by itself.

Documents are dealt into ranges of doc_id by one shuffle; each range is a part and is tokenized in order, so blocks need no
further sorting. A block has about 262,144 ids and whole documents only (a longer document is a block alone). ``start`` of a document is the ids of
all parts before, of the blocks before in its part and of the documents before in its block.

Defined results: a null text is empty and has the end id alone; null ids come first; documents repeated with one id stay, in
the order of their texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajspark.llm.common import saved
from trajspark.llm.huffman import Code, code_lengths
from trajspark.llm.pretokens import Encoder, Pretokens
from trajspark.llm.words import chunks

END_ID = 2
BLOCK_IDS = 1 << 18
EVERY = 128
LIMIT = 16
KEPT_PIECES = 1_000_000  # distinct pre-tokens whose ids a worker keeps


class Library:
    """The tokenizers library on pre-tokens; texts whose pre-tokens depend on the edition of Unicode go to it whole.

    With ``added_tokens`` so do texts that hold an added token of the vocabulary, which the library finds before it makes
    pre-tokens; without, special tokens are encoded as the text they are.
    """

    def __init__(self, path: str, added_tokens: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.whole = Tokenizer.from_file(path) if added_tokens else self.tokenizer
        added = self.whole.get_added_tokens_decoder().values() if added_tokens else ()
        self.added = [t.content.encode() for t in added if t.content]
        self.encoder = Encoder(self._pieces, KEPT_PIECES)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        lists = [e.ids for e in found]
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        return np.fromiter((i for ids in lists for i in ids), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _holding_added(self, texts) -> set[int]:
        raw, found = texts.bytes.tobytes() if self.added else b"", set()
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                i = int(np.searchsorted(texts.offsets, at, side="right")) - 1
                if at + len(content) <= texts.offsets[i + 1]:
                    found.add(i)
                at = raw.find(content, at + 1)
        return found

    def documents(self, texts) -> list[np.ndarray]:
        pretokens = Pretokens(texts)
        ids, bounds = self.encoder.ids(pretokens)
        out = np.split(ids, bounds[1:-1])
        for i in sorted({*pretokens.doubtful.tolist(), *self._holding_added(texts)}):
            text = texts.bytes[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
            out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return out


@cache
def _library(path: str, added_tokens: bool) -> Library:
    return Library(path, added_tokens)


def ordered_blocks(
    docs: DataFrame, tokenizer_file: str, id_col: str, text_col: str, end_id: int, block_ids: int, added_tokens: bool = False
) -> DataFrame:
    """Blocks of ids in ascending doc_id order, written to the shared folder."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    names = ["part", "block", "offset", "doc_ids", "lengths", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, part = _library(tokenizer_file, added_tokens), TaskContext.get().partitionId()
        block, offset, size, doc_ids, pieces = 0, 0, 0, [], []

        def row() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            cells = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([offset], pa.int64()),
                     pa.array([doc_ids], pa.list_(id_type)), pa.array([[len(p) for p in pieces]], pa.list_(pa.int32())),
                     pa.array([ids.astype(np.uint16 if small else np.uint32).tobytes()], pa.binary())]
            return pa.record_batch(cells, names)

        small, id_type = library.size <= 1 << 16 and end_id < 1 << 16, pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for start, stop, texts in chunks(batch, "text"):
                for name, ids in zip(batch.column(0).slice(start, stop - start).to_pylist(), library.documents(texts), strict=True):
                    doc_ids.append(name)
                    pieces.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= block_ids:
                        yield row()
                        block, offset, size, doc_ids, pieces = block + 1, offset + size, 0, [], []
        if doc_ids:
            yield row()

    schema = f"part int, block int, offset long, doc_ids array<{kind}>, lengths array<int>, ids binary"
    return saved(own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, schema), "token-blocks")


def _wide(raw: bytes, total: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint16 if len(raw) == 2 * total else np.uint32).astype(np.uint32)


def global_counts(blocks: DataFrame) -> DataFrame:
    """(symbol, n) over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for lengths, ids in zip(batch.column(0), batch.column(1), strict=True):
                own = np.bincount(_wide(ids.as_py(), int(np.asarray(lengths.values).sum())))
                if len(own) > len(counts):
                    own[: len(counts)] += counts
                    counts = own
                else:
                    counts[: len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], ["symbol", "n"])

    return blocks.select("lengths", "ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID,
    block_ids: int = BLOCK_IDS, every: int = EVERY, limit: int = LIMIT, added_tokens: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Write the folder of the module docstring; returns its ``files`` and ``code`` as read back."""
    blocks = ordered_blocks(docs, tokenizer_file, id_col, text_col, end_id, block_ids, added_tokens)
    found = global_counts(blocks).collect()  # one row per id of the vocabulary
    counts = np.zeros(max((r["symbol"] for r in found), default=0) + 1, dtype=np.int64)
    for r in found:
        counts[r["symbol"]] = r["n"]
    lengths = code_lengths(counts, max(limit, int(np.count_nonzero(counts)).bit_length()))
    spark = docs.sparkSession
    symbols = np.flatnonzero(lengths).tolist()
    code = saved(spark.createDataFrame([(s, int(lengths[s])) for s in symbols], "symbol int, bits int").coalesce(1), "token-code")
    shared = spark.sparkContext.broadcast(lengths)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Code(shared.value)
        for batch in batches:
            ids = batch.column(5)
            for i in range(batch.num_rows):
                total = int(np.asarray(batch.column(4)[i].values).sum())
                payload, points = own.encode(_wide(ids[i].as_py(), total), every)
                yield pa.record_batch(
                    [*(batch.column(c).slice(i, 1) for c in range(5)), pa.array([payload], pa.binary()), pa.array([points], pa.list_(pa.int64()))],
                    ["part", "block", "offset", "doc_ids", "lengths", "payload", "points"])

    schema = f"part int, block int, offset long, doc_ids array<{kind}>, lengths array<int>, payload binary, points array<long>"
    return saved(blocks.mapInArrow(run, schema), "token-files"), code


def read_token_files(files: DataFrame, code: DataFrame, *, every: int = EVERY) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession
    table = code.collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r["symbol"] for r in table), default=0) + 1, dtype=np.uint8)
    for r in table:
        lengths[r["symbol"]] = r["bits"]
    shared = spark.sparkContext.broadcast(lengths)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Code(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = np.asarray(batch.column(3)[i].values).astype(np.int64)
                to = np.cumsum(sizes)
                ids = own.decode(batch.column(4)[i].as_py(), np.asarray(batch.column(5)[i].values), int(to[-1]), every)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(to.tolist(), sizes.tolist(), strict=True)]
                yield pa.record_batch(
                    [pa.array([batch.column(0)[i].as_py()] * len(to), pa.int32()), pa.array(batch.column(1)[i].as_py() + to - sizes),
                     batch.column(2)[i].values, pa.array(sizes), pa.array(crc, pa.int64())],
                    ["part", "place", "doc_id", "n_tokens", "ids_crc32"])

    rows = files.select("part", "offset", "doc_ids", "lengths", "payload", "points").mapInArrow(
        run, f"part int, place long, doc_id {kind}, n_tokens long, ids_crc32 long")
    sizes = files.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    bases = totals.select("part", before.alias("base"))  # one row per part of the range shuffle
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write token files and read them back: doc_id, start, n_tokens, ids_crc32."""
    files, code = write_token_files(docs, tokenizer_file, id_col, text_col, **options)
    return read_token_files(files, code, every=options.get("every", EVERY))
