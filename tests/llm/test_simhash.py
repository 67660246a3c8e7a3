import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from trajspark.llm.components import components
from trajspark.llm.simhash import Golay, block_masks, bucket_keys, drop_near_duplicates, fingerprint_components, near_duplicates


def fingerprint(text):
    data = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_two_bits_apart_share_a_key():
    golay, rng = Golay(), random.Random(1)
    for _ in range(200):
        word = rng.getrandbits(23)
        other = word ^ sum(1 << p for p in rng.sample(range(23), 2))
        assert set(golay.keys(np.array([word]))[1]) & set(golay.keys(np.array([other]))[1])


def test_four_bits_apart_share_a_bucket():
    golay, rng = Golay(), random.Random(2)
    a = np.array([rng.getrandbits(64) for _ in range(3000)], dtype=np.uint64)
    flips = [sum(1 << p for p in rng.sample(range(64), rng.randint(0, 4))) for _ in a]
    b = a ^ np.array(flips, dtype=np.uint64)
    (ra, ka), (rb, kb) = bucket_keys(a, golay), bucket_keys(b, golay)
    own = {}
    for r, k in zip(ra.tolist(), ka.tolist(), strict=True):
        own.setdefault(r, set()).add(k)
    assert {r for r, k in zip(rb.tolist(), kb.tolist(), strict=True) if k in own[r]} == set(range(len(a)))


def test_dense_cluster_is_linked_exactly(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 7))) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(100)} | {0, 1, 7}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    close = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    want = groups(signed, close)
    got = {r.node: r.component for r in fingerprint_components(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    assert {p: got.get(p, p) for p in signed} == want


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    prints = {(r.doc_id, r.text): fingerprint(r.text) for r in rows}
    distinct = sorted(set(prints.values()))
    of = groups(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4])
    first = {}
    for (i, _), p in prints.items():
        if i is not None:
            first[of[p]] = min(i, first.get(of[p], i))
    want = sorted(((r.doc_id, f"{fingerprint(r.text):016x}", first.get(of[fingerprint(r.text)])) for r in rows), key=str)
    assert sorted([tuple(r) for r in near_duplicates(odd_docs).collect()], key=str) == want
    left = drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _, c in want if i is None or i == c}
    assert near_duplicates(no_docs).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(600, 660)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    want = groups({n for link in links for n in link}, links)
    assert got == {n: c for n, c in want.items() if n in got}
    assert {n for a, b in links if a != b for n in (a, b)} == set(got)


def test_crowded_buckets_are_split_without_losing_a_pair(spark):
    """Many fingerprints with one segment and close second segments, most of them far apart: whatever the split, the links stay."""
    rng = random.Random(6)
    prints = set()
    for _ in range(400):
        prints.add((rng.getrandbits(21) << 43) | (sum(1 << (22 + p) for p in rng.sample(range(21), rng.randint(0, 1)))) | 12345)
    for p in list(prints)[:80]:
        prints.add(p ^ sum(1 << b for b in rng.sample(range(43, 64), rng.randint(1, 4))))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    close = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    got = {r.node: r.component for r in fingerprint_components(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    assert {p: got.get(p, p) for p in signed} == groups(signed, close)


def test_blocks_meet_for_every_pair_within_reach():
    rng = random.Random(7)
    for width in (42, 43, 64):
        for equal in (1, 2, 3):
            masks = [m & (1 << 64) - 1 for m in block_masks(width, equal)]
            for _ in range(200):
                bits = sum(1 << p for p in rng.sample(range(width), 4))
                assert any(not m & bits for m in masks)


def test_rows_without_ids_and_names_of_other_columns(spark):
    rows = [(None, "one two three four five"), (3, "ONE two three four five"), (3, "something else that is far away"), (4, None), (None, ""), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"name": F.lit("n"), "fp": F.lit(1), "digest": F.lit("d"), "copies": F.lit(9)})
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "").lower(), r.name, r.digest) for r in left.collect()) == [
        (3, "one two three four five", "n", "d"), (3, "something else that is far away", "n", "d"), (4, "", "n", "d")]
