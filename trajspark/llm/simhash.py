"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has 64 bits. It is cut into segments of 22, 21 and 21 bits, each a word of the perfect binary Golay code [23, 12, 7] (padded
with zeros). The fuzzy keys of a word are the codewords that it and its one-bit neighbours decode to: one key for words
within 2 of a codeword, six for the others; two words that differ in at most 2 bits share a key, and a word's own codeword is a
key of every word one bit away. Fingerprints at most 4 bits apart then meet under one of two kinds of bucket, by pigeonhole
on the errors of the segments:

* some segment is equal, and another has at most 2 errors: (equal segment, fuzzy key of the other);
* no segment is equal, so the errors are 1, 1 and 1 or 2: two segments with one error each, and one of three pieces of the
  third segment without: (fuzzy key of one, codeword of the other, piece of the third).

Only distinct fingerprints are keyed, so copies meet nobody. Pairs inside a bucket are never listed. The smallest fingerprint of a bucket is
its leader; every member is compared with it, and components are formed. After that only members whose component differs from their
leader's are compared with the members of other components in their bucket. A dense group of near copies has one
component by then; every pair that could still join two components is verified, so no link is lost.

A bucket that many different fingerprints share is split again before that: what its fingerprints aren't known to have in common is cut into
``MAX_BITS`` + t blocks, of which t are equal for any two within the distance, and each choice of t blocks is a key of its own. t grows with the
bucket, so keys get some 8, 14 or 18 bits more and pairs are compared in small groups; again no pair is lost.

Defined results: a null or empty text has no words and fingerprint zero, which links like any other; null ids get their own
fingerprint and the component of it (null when all its ids are null); repeated rows are alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import constant_array, discard, kept_rows, saved, text_digest
from trajspark.llm.components import components
from trajspark.llm.words import NOT_SPACE, Words, chunks, release_memory

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 50_000
PIECES = 3
CROWD = 64
SPLITS = ((1 << 14, 1), (1 << 20, 2), (None, 3))  # buckets of up to so many fingerprints: blocks that have to be equal
PRINTS_AT_ONCE = 4_000
PRINTS_A_TASK = 20_000  # a fingerprint makes some 120 rows
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the Golay code


def shingle_fingerprints(words: Words, shingle: int) -> np.ndarray:
    """SimHash of each text: a bit is set when it is set in more than half of the XXH64 values of its shingles."""
    lengths = words.ends - words.starts
    to = np.cumsum(lengths + 1)
    begin = to - lengths - 1
    source = np.repeat(words.starts - begin, lengths + 1) + np.arange(int(to[-1]) if len(to) else 0)
    joined = words.data[source] if len(source) else np.zeros(0, np.uint8)
    joined[to - 1] = 32
    raw = joined.tobytes()
    counts = np.diff(words.bounds)
    each = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first = np.repeat(words.bounds[:-1], each) + _within(each)
    last = np.minimum(first + shingle, np.repeat(words.bounds[1:], each)) - 1
    text = np.repeat(np.arange(len(counts)), each)
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    for at in range(0, len(first), BLOCK):
        block = slice(at, at + BLOCK)
        pieces = [raw[a:b] for a, b in zip(begin[first[block]].tolist(), (to[last[block]] - 1).tolist(), strict=True)]
        values = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype=np.uint64, count=len(pieces))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner, start = np.unique(text[block], return_index=True)
        ones[owner] += np.add.reduceat(bits, start, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > each[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _within(each: np.ndarray) -> np.ndarray:
    return np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id and its fingerprint as a signed 64-bit number ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in chunks(batch, "text"):
                prints = shingle_fingerprints(Words(texts, NOT_SPACE, lower=True), shingle)
                yield pa.record_batch([batch.column(0).slice(start, stop - start), pa.array(prints.view(np.int64))], ["doc_id", "fp"])
        release_memory()

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, fp long")


class Golay:
    """Decoding of 23-bit words by syndrome, built from the generator."""

    def __init__(self):
        syndromes = np.array([self._remainder(1 << i) for i in range(23)])
        self.errors = np.zeros(2048, dtype=np.int64)
        for n in (1, 2, 3):
            for places in combinations(range(23), n):
                self.errors[np.bitwise_xor.reduce(syndromes[list(places)])] = sum(1 << p for p in places)
        self.parts = []
        for low in (0, 8, 16):
            table = np.zeros(256, dtype=np.int64)
            for bit in range(min(8, 23 - low)):
                table[(np.arange(256) >> bit & 1) == 1] ^= syndromes[low + bit]
            self.parts.append(table)

    @staticmethod
    def _remainder(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GENERATOR << (i - 11)
        return word

    def decode(self, words: np.ndarray) -> np.ndarray:
        """The index (12 bits) of the codeword within 3 bits of each word."""
        a, b, c = self.parts
        syndrome = a[words & 255] ^ b[words >> 8 & 255] ^ c[words >> 16]
        return (words ^ self.errors[syndrome]) >> 11

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of the distinct fuzzy keys of each word."""
        flips = np.concatenate([[0], 1 << np.arange(23)])
        found = np.sort(self.decode(words[:, None] ^ flips[None, :]), axis=1)
        new = np.ones(found.shape, dtype=bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        rows, columns = np.nonzero(new)
        return rows, found[rows, columns]


def bucket_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all buckets of each fingerprint; a key names its table in the bits above 34."""
    parts = [((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    fuzzy = [golay.keys(p) for p in parts]
    own = [golay.decode(p) for p in parts]
    rows, keys, table = [], [], 0
    for i in range(3):
        for j in range(3):
            if i == j:
                continue
            who, key = fuzzy[j]
            rows.append(who)
            keys.append((np.int64(table) << 34) | (parts[i][who] << 12) | key)
            once = (key != own[j][who]) | (i < j)
            who, pair = who[once], _pair(i, j, own[i][who], key)[once]
            for piece in range(PIECES):
                rows.append(who)
                keys.append((np.int64(6 + PIECES * (i + j - 1) + piece) << 34) | (pair << 8) | _piece(parts[3 - i - j][who], piece))
            table += 1
    return np.concatenate(rows), np.concatenate(keys)


def _piece(segment: np.ndarray, piece: int) -> np.ndarray:
    """Seven bits of a segment; the last piece takes what is left."""
    return segment >> 14 if piece == 2 else segment >> 7 * piece & 127


def _pair(i: int, j: int, own: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Both kinds of row of a pair of segments meet in one bucket, written with the lower segment first."""
    return (own << 12) | key if i < j else (key << 12) | own


def fuzzy_buckets(prints: DataFrame) -> DataFrame:
    """(key, fp) for distinct fingerprints ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            column = np.asarray(batch.column(0))
            for start in range(0, len(column), PRINTS_AT_ONCE):
                part = column[start : start + PRINTS_AT_ONCE]
                rows, keys = bucket_keys(part.view(np.uint64), golay)
                yield pa.record_batch([pa.array(keys), pa.array(part[rows])], ["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, fp long")


def near(a, b, bits: int = MAX_BITS):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def block_masks(width: int, equal: int) -> list[int]:
    """Bits of every choice of ``equal`` blocks when ``width`` bits are cut into that many more than the bits that may differ."""
    n = MAX_BITS + equal
    cuts = [width * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(c) for c in combinations(blocks, equal)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _masked(bits: Column):
    return lambda mask, number: F.xxhash64(number, bits.bitwiseAND(mask))


def split_keys(key: str, fp: str, n: str) -> Column:
    """Keys inside a bucket of ``n`` fingerprints: one for all of a small bucket, else one for each choice of equal blocks outside the
    segment that the bucket's fingerprints have in common."""
    table = F.shiftrightunsigned(key, 34)
    out = F.lit(None)
    for i, (low, width) in enumerate([*SEGMENTS, (64, 0)]):
        rest = F.col(fp)
        if width:
            upper = F.shiftrightunsigned(fp, low + width) if low + width < 64 else F.lit(0).cast("long")
            rest = F.col(fp).bitwiseAND(F.lit((1 << low) - 1).cast("long")).bitwiseOR(F.shiftleft(upper, low))
        split = F.lit(None)
        for most, equal in reversed(SPLITS):
            masks = constant_array(block_masks(64 - width, equal), "bigint")
            keys = F.transform(masks, _masked(rest))
            split = keys if most is None else F.when(F.col(n) <= most, keys).otherwise(split)
        out = F.when(F.floor(table / 2) == i, split).otherwise(out) if width else F.when(table >= 6, split).otherwise(out)
    return F.when(F.col(n) <= CROWD, F.array(F.lit(0).cast("long"))).otherwise(out)


def fingerprint_components(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(node, component) for the distinct fingerprints that link to another one."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys find fingerprints of at most {MAX_BITS} differing bits")
    tasks = prints.count() // PRINTS_A_TASK + 1
    rows = saved(fuzzy_buckets(prints.repartition(tasks, "fp")), "simhash-buckets")
    leaders = rows.groupBy("key").agg(F.min("fp").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = saved(rows.join(leaders, "key"), "simhash-members")
    discard(rows)
    led = members.filter("fp <> leader").filter(near("fp", "leader", bits)).select(F.col("fp").alias("a"), F.col("leader").alias("b"))
    first = saved(components(led, "simhash-led"), "simhash-first")

    own = first.select(F.col("node").alias("fp"), F.col("component").alias("own"))
    lead = first.select(F.col("node").alias("leader"), F.col("component").alias("main"))
    more = members.filter("n > 2").join(own, "fp", "left").join(lead, "leader", "left")
    more = saved(more.select("key", "n", "fp", F.coalesce("own", "fp").alias("own"), F.coalesce("main", "leader").alias("main")), "simhash-open")
    discard(members)
    # only buckets that still hold several components, each with the members that could join two of them
    open_keys = more.groupBy("key").agg(F.max((F.col("own") != F.col("main")).cast("int")).alias("several")).filter("several = 1").select("key")
    more = more.join(open_keys, "key", "left_semi").withColumn("sub", F.explode(split_keys("key", "fp", "n")))
    apart = more.filter("own <> main").select("key", "sub", F.col("fp").alias("fp_2"), F.col("own").alias("own_2"))
    met = more.join(apart, ["key", "sub"]).filter("own <> own_2").filter(near("fp", "fp_2", bits))
    joined = components(met.select(F.col("own").alias("a"), F.col("own_2").alias("b")), "simhash-met")
    joined = joined.withColumnRenamed("node", "old").withColumnRenamed("component", "new")

    everyone = first.unionByName(
        joined.join(first, F.col("old") == F.col("component"), "left_anti").select(F.col("old").alias("node"), F.col("old").alias("component")))
    return everyone.join(joined, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links lead to)."""
    own = saved(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return own.join(_named(own, F.col("doc_id"), bits), "fp").select("doc_id", digits.alias("fingerprint"), F.col("least").alias("component_id"))


def _named(own: DataFrame, order: Column, bits: int) -> DataFrame:
    """(fp, least): for each fingerprint the least ``order`` of its component."""
    first = saved(own.groupBy("fp").agg(F.min(order).alias("first")), "simhash-distinct")
    linked = fingerprint_components(first, bits)
    grouped = first.join(linked, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("first").alias("least"))
    return grouped.join(least, "component").select("fp", "least")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows are told apart by id and text: a row without an id goes when its component has another, and of rows that share an id the one
    whose text has the least digest stays.
    """
    named = docs.select(
        F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")).alias("name"),
        F.col(text_col).alias("text"))
    own = saved(fingerprints(named, "name", "text", shingle).withColumnRenamed("doc_id", "name"), "simhash-prints")
    least = _named(own, F.col("name"), bits).select(F.col("least").alias("name")).distinct()
    rows = least.join(own, "name").groupBy("name").agg(F.count(F.lit(1)).alias("copies"))
    kept = saved(rows.select(F.col("name.id").alias("id"), F.col("name.digest").alias("digest"), "copies"), "simhash-kept")
    return kept_rows(docs, id_col, text_digest(F.col(text_col)), kept)
