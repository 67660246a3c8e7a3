"""Exact deduplication with an extendible-hash index on shared files; DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. The 64-bit hash of a text is its key, and the leading bits of the
key are its slot in a directory. The directory starts with one bucket and doubles while a bucket holds more bytes than a
bucket may; only the overfull buckets split. A text counts once however many rows repeat it.

The directory then routes the rows: an owner task gets all of a (bucket, key), copies merged in each scanning task before the shuffle, and chains
the different texts of that key, compared byte by byte. A text's place in its chain tells it from others of its key. Index files hold the chains
sorted by bucket and key. Documents are looked up by (bucket, key, chain): almost every chain has one text, which then is the text of all
rows of that key; rows of the few keys that collide find their place by digest. Groups are the rows of one (bucket, key, chain).

The largest groups, which are few for their size, are broadcast when they are met by their rows, so a text that a third of the rows repeat
gathers in no task.

Defined results: a null text counts as empty; null ids never stay unless all ids of the group are null; of rows repeated
with the same id one stays; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import ascii_lower, constant_array, discard, kept_rows, saved
from trajspark.settings import broadcast_if

BUCKET_BYTES = 8 << 20
BUCKETS = 1 << 16  # buckets grow beyond their least size rather than the directory beyond some such number
MAX_DEPTH = 20
HOT_ROWS = 50_000


@dataclass(frozen=True)
class Directory:
    """``slots[i]`` is the first slot of the bucket that slot i belongs to; ``depths[i]`` is that bucket's own depth."""

    depth: int
    slots: list[int]
    depths: list[int]

    def bucket(self, key: Column) -> Column:
        return F.get(constant_array(self.slots, "int"), slot_of(key, self.depth))


def slot_of(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key."""
    if depth == 0:
        return F.lit(0)
    return F.shiftrightunsigned(key, 64 - depth).cast("int")


def double_directory(loads_at: Callable[[int], dict[int, int]], first: int, bucket_bytes: int, max_depth: int) -> Directory:
    """Double a directory until no bucket is overfull or ``max_depth`` is reached.

    ``loads_at(d)`` gives the bytes under each prefix of d bits; it is asked at depth ``first`` (loads of shorter prefixes are sums
    of it) and again only beyond. A bucket that is still overfull at ``max_depth`` keeps its entries as a longer chain.
    """
    known = min(first, max_depth)
    loads = loads_at(known)
    depth, depths, overfull = 0, [0], {0}
    while depth <= max_depth:
        if depth > known:
            known, loads = depth, loads_at(depth)
        at_depth: dict[int, int] = {}
        for prefix, size in loads.items():
            at_depth[prefix >> (known - depth)] = at_depth.get(prefix >> (known - depth), 0) + size
        overfull = {s for s, d in enumerate(depths) if d == depth and at_depth.get(s, 0) > bucket_bytes}
        if not overfull or depth == max_depth:
            break
        depths = [d + 1 if s in overfull else d for s, d in enumerate(depths) for _ in range(2)]
        depth += 1
    slots = [(s >> (depth - d)) << (depth - d) for s, d in enumerate(depths)]
    return Directory(depth, slots, depths)


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, bucket_bytes: int = BUCKET_BYTES,
    max_depth: int = MAX_DEPTH, key_of: Callable[[Column], Column] = text_key,
) -> tuple[DataFrame, Directory]:
    """The index, one row per different text: bucket, key, chain, text_sha256, n_bytes.

    Files hold ranges of (bucket, key). ``chain`` counts from 0 the texts that share a key. ``max_depth`` bounds the directory (2**max_depth
    slots), not what a bucket may hold.
    """
    keyed = _normal(docs, id_col, text_col).select(key_of(F.col("text")).alias("key"), "text")
    keys = saved(keyed.groupBy("key").agg(F.max(F.octet_length("text")).cast("long").alias("n_bytes")), "dedup-keys")
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    capacity = max(bucket_bytes, total // BUCKETS)
    first = min(max_depth, max(0, (total // capacity)).bit_length() + 2)

    def loads_at(depth: int) -> dict[int, int]:
        rows = keys.groupBy(slot_of(F.col("key"), depth).alias("slot")).agg(F.sum("n_bytes").alias("n")).collect()
        return {r["slot"]: r["n"] for r in rows}

    directory = double_directory(loads_at, first, capacity, max_depth)
    discard(keys)
    owned = keyed.select(directory.bucket(F.col("key")).alias("bucket"), "key", "text").groupBy("bucket", "key")
    chains = owned.agg(F.array_sort(F.collect_set("text")).alias("texts")).select("bucket", "key", F.posexplode("texts").alias("chain", "text"))
    index = chains.select(
        "bucket", "key", "chain", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("n_bytes"))
    index = saved(index, "dedup-chains")
    placed = index.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain")
    return saved(placed, "dedup-index"), directory


def _normal(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))


def _located(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """(doc_id, text_sha256, copies, keep_id, group_size): rows that share id and text, with their group."""
    key_of = options.get("key_of", text_key)
    index, directory = build_index(docs, id_col, text_col, **options)
    key = key_of(F.col("text"))
    entries = _normal(docs, id_col, text_col).select("doc_id", key.alias("key"), F.sha2("text", 256).alias("text_sha256"))
    entries = entries.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    entries = saved(entries.withColumn("bucket", directory.bucket(F.col("key"))), "dedup-entries")

    collided = index.join(index.filter("chain > 0").select("bucket", "key").distinct(), ["bucket", "key"], "left_semi")
    collided = saved(collided.select("bucket", "key", "text_sha256", F.col("chain").alias("found")), "dedup-collided")
    met = entries.join(broadcast_if(collided, collided.count()), ["bucket", "key", "text_sha256"], "left")
    placed = met.withColumn("chain", F.coalesce("found", F.lit(0))).drop("found")

    groups = placed.groupBy("bucket", "key", "chain").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups = saved(groups.filter("group_size > 1"), "dedup-groups")
    hot = groups.filter(F.col("group_size") > HOT_ROWS)
    n_hot, where = hot.count(), ["bucket", "key", "chain"]
    alone = placed.join(broadcast_if(hot, n_hot), where, "left_anti").join(groups.filter(F.col("group_size") <= HOT_ROWS), where, "left")
    found = alone.unionByName(placed.join(broadcast_if(hot, n_hot), where)) if n_hot else placed.join(groups, where, "left")
    single = F.col("group_size").isNull()
    return found.select(
        "doc_id", "text_sha256", "copies", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = _located(docs, id_col, text_col, **options)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    found = _located(docs, id_col, text_col, **options).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = saved(found.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest"), "copies"), "dedup-kept")
    return kept_rows(docs, id_col, F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256), kept)
