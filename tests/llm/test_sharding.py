import heapq
import zlib
from collections import defaultdict

from trajspark.llm.sharding import deal, shard_documents


def check_laws(docs, shards):
    rows = docs.collect()
    got = shard_documents(docs, shards=shards, slice_rows=3).collect()
    assert len(got) == len(rows)
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    slots, loads, shard_of = defaultdict(list), [0] * shards, defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        shard_of[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    groups = defaultdict(int)
    for r in rows:
        groups[r.text or ""] += len((r.text or "").encode()) + 16
    heap = [0] * shards
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert max(loads) <= max(heap) * 1.001 + 1


def test_odd_rows(odd_docs, no_docs):
    check_laws(odd_docs, 4)
    assert shard_documents(no_docs).count() == 0


def test_many_small_groups_and_one_hot(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'copy' ELSE repeat('x', CAST(id % 50 AS int)) || id END AS text")
    check_laws(docs, 7)


def test_dealing_by_count_levels_like_the_heap():
    dealt = deal([(1, 1000, 10.0), (2, 3, 70.0), (3, 1, 5000.0)], 4)
    loads = [dealt[1][s] * 10 + dealt[2][s] * 70 + dealt[3][s] * 5000 for s in range(4)]
    heap = [0.0] * 4
    for size in [5000.0] + [70.0] * 3 + [10.0] * 1000:
        heapq.heapreplace(heap, heap[0] + size)
    assert sorted(loads) == sorted(heap)
