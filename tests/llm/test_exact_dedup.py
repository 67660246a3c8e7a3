from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trajspark.llm.exact_dedup import build_index, double_directory, drop_exact_duplicates, exact_duplicates

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(UPPER)].append(r.doc_id)
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids)) for i in ids]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("key_of", [F.xxhash64, lambda text: F.lit(7).cast("long")], ids=["hash", "one key for all"])
def test_groups(odd_docs, key_of):
    want, groups = expected(odd_docs.collect())
    got = exact_duplicates(odd_docs, key_of=key_of).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == want
    assert sum(r.kept for r in got) == groups
    kept = drop_exact_duplicates(odd_docs, key_of=key_of)
    assert kept.columns == odd_docs.columns
    assert kept.count() == groups


def test_chain_and_files(odd_docs):
    index, directory = build_index(odd_docs, key_of=lambda text: F.length(text).cast("long"), bucket_bytes=64, max_depth=3)
    rows = index.collect()
    chains = defaultdict(list)
    for r in rows:
        chains[r.key].append(r.chain)
    assert sorted(chains[7]) == [0, 1], "two texts of seven characters"
    assert all(sorted(c) == list(range(len(c))) for c in chains.values())
    assert directory.depth <= 3


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).count() == 0


def test_directory_doubles_only_overfull_buckets():
    keys = {0b000: 10, 0b001: 10, 0b011: 1, 0b100: 1, 0b111: 1}

    def loads_at(depth):
        out = defaultdict(int)
        for k, n in keys.items():
            out[(k << 10) >> (13 - depth)] += n
        return out

    directory = double_directory(loads_at, 0, 12, 10)
    assert directory.depth == 3
    assert directory.depths == [3, 3, 2, 2, 1, 1, 1, 1]
    assert directory.slots == [0, 1, 2, 2, 4, 4, 4, 4]
    assert double_directory(loads_at, 3, 12, 10) == directory
    assert double_directory(loads_at, 0, 12, 2).depth == 2


def test_names_of_other_columns_are_left_alone(spark):
    rows = [(1, "A", "x", 5), (1, "a", "y", 6), (2, "b", "z", 7), (None, "b", "w", 8), (None, "c", "v", 9), (None, "c", "v", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, copies int").withColumns(
        {"kept_id": F.lit(1), "kept_digest": F.lit("k"), "_sha": F.lit("s"), "_copy": F.lit(3), "chain": F.lit(0), "bucket": F.lit(0)})
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text.lower(), r.digest in "xyzwv", r.kept_id, r._sha, r._copy) for r in left.collect())
    assert got == [(0, "c", True, 1, "s", 3), (1, "a", True, 1, "s", 3), (2, "b", True, 1, "s", 3)]


def test_large_groups_are_broadcast(spark, monkeypatch):
    from trajspark.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 3)
    rows = [(i, "same" if i % 3 else f"t{i % 12}", ) for i in range(60)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    by = defaultdict(list)
    for i, t in rows:
        by[t].append(i)
    assert got == {i: (max(by[t]), len(by[t])) for i, t in rows}
