"""Sharding by longest processing time: groups that stay together, sorted by size, go to the least-loaded shard.

The size of a row is the UTF-8 bytes of its text plus 16; rows with equal texts are a group. Groups are counted with copies merged
before the shuffle and sorted into classes: each of the few groups that hold a notable share of the bytes or rows is a class of its own,
all others share a class with groups of their size, exact up to 4096 bytes and within 1/2048 beyond. Classes number some tens of
thousands whatever the input, so the heap runs over them on the driver: largest class first, each group to the least-loaded shard.
Groups of one class are alike, so they are dealt by count: the heap's outcome is a number of groups for each shard,
found by levelling the loads, and the last few go through the heap one by one. Which group goes where follows from its rank
inside its class; ranks and slots are numbered in slices of bounded size, with running offsets over the slices.

The law that holds is ``bytes``: shard sizes are as near as the groups allow. A group larger than a shard's share fills a shard
alone and is never split.

Defined results: a null text has no bytes, crc 0 and is one group with the empty texts; null ids and repeated rows are rows
like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajspark.llm.common import saved

SHARDS = 40
SLICE_ROWS = 50_000
EXACT_SIZE = 4096
STEPS = 2048
LARGE_PER_SHARD = 64


def deal(classes: list[tuple[int, int, float]], shards: int) -> dict[int, list[int]]:
    """Counts of groups per shard for each (class, groups, mean size), classes by falling size, least-loaded shard first."""
    heap = [(0.0, s) for s in range(shards)]
    dealt = {}
    for name, count, size in sorted(classes, key=lambda c: (-c[2], c[0])):
        taken = [0] * shards
        if count > 2 * shards:
            loads = sorted(heap)
            low, high = loads[0][0], loads[0][0] + size * count
            for _ in range(200):
                level = (low + high) / 2
                if sum(int(max(0.0, level - load) // size) for load, _ in loads) <= count:
                    low = level
                else:
                    high = level
            heap = []
            for load, s in loads:
                taken[s] = int(max(0.0, low - load) // size)
                heap.append((load + taken[s] * size, s))
            heapq.heapify(heap)
        for _ in range(count - sum(taken)):
            load, s = heapq.heappop(heap)
            taken[s] += 1
            heapq.heappush(heap, (load + size, s))
        dealt[name] = taken
    return dealt


def size_class(size: Column) -> Column:
    """A size, exact up to 4096 and rounded down to 1/2048 of its leading power of two beyond."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(size.cast("double")))) / STEPS
    return F.when(size <= EXACT_SIZE, size).otherwise((F.floor(size / unit) * unit).cast("long"))


def numbered(rows: DataFrame, group: str, order: list[str], label: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``number``, gapless from 0 in each group, without a task that holds a whole group.

    There are only as many groups as shards or size classes, so their sizes are broadcast. Rows are dealt into slices by a hash of the order columns, slices are counted first, and a row's number is its slice's
    offset plus its position there.
    """
    sizes = rows.groupBy(group).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / slice_rows)).cast("long").alias("_slices"))
    sliced = rows.join(F.broadcast(sizes), group).withColumn("_slice", F.pmod(F.xxhash64(*order), F.col("_slices"))).drop("_slices")
    sliced = saved(sliced, f"{label}-slices")
    counts = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = counts.select(group, "_slice", (before - F.col("_n")).alias("_before"))
    position = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order)) - 1
    return (
        sliced.withColumn("_position", position)
        .join(offsets, [group, "_slice"])
        .withColumn("number", F.col("_before") + F.col("_position"))
        .drop("_slice", "_position", "_before")
    )


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"),
            F.monotonically_increasing_id().alias("salt"),  # tells rows apart that are alike, so they don't gather in one slice
        ),
        "shard-rows",
    )
    groups = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    part = shards * LARGE_PER_SHARD
    large = (F.col("bytes") * part >= F.lit(total["bytes"] or 0)) | (F.col("n") * part >= F.lit(total["n"] or 0))
    biggest = groups.filter(large).select("key", "bytes").orderBy(F.desc("bytes"), "key").collect()  # at most 2 * part
    small = groups.filter(~large).withColumn("class", size_class(F.col("bytes")))
    by_size = small.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.avg("bytes").alias("mean")).collect()
    dealt = deal(
        [(r["class"], r["n"], r["mean"]) for r in by_size] + [(-1 - i, 1, float(r["bytes"])) for i, r in enumerate(biggest)], shards
    )
    spark = docs.sparkSession
    alone = spark.createDataFrame(
        [(bytearray(r["key"]), dealt[-1 - i].index(1)) for i, r in enumerate(biggest)], "key binary, shard int")
    ends = spark.createDataFrame([(c, _running(t)) for c, t in dealt.items() if c >= 0], "class long, ends array<long>")
    ranked = numbered(small.select("key", "class"), "class", ["key"], "shard-ranks", slice_rows).join(ends, "class")
    placed = ranked.select("key", F.size(F.filter("ends", lambda e: e <= F.col("number"))).alias("shard"))
    first = rows.join(F.broadcast(alone), "key", "left")
    sharded = first.filter("shard is not null").unionByName(first.filter("shard is null").drop("shard").join(placed, "key"))
    slotted = numbered(sharded.drop("key"), "shard", ["doc_id", "text_crc32", "size", "salt"], "shard-slots", slice_rows)
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("number").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _running(counts: list[int]) -> list[int]:
    total, out = 0, []
    for n in counts:
        total += n
        out.append(total)
    return out
