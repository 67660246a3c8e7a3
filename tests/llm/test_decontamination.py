import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from trajspark.llm.decontamination import build_index, contamination, drop_contaminated, search_index

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def expected(docs, items, size):
    windows = [(n, w[i : i + size]) for n, t in items if (w := words(t)) for i in range(max(1, len(w) - size + 1))]
    out = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for name, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def random_case():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "B", "c1", "é", "d", "e-f"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(120)] + [(1, "a B"), (None, "a b c1"), (500, None)]
    items = [(i, text(rng.randint(1, 9))) for i in range(8)] + [(8, None), (9, ""), (None, "c1 c1"), (10, "a b"), (10, "a b")]
    return docs, items


@pytest.mark.parametrize("block_words", [500_000, 1], ids=["one block", "many blocks"])
def test_against_direct_search(spark, random_case, block_words):
    docs, items = random_case
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(d, b, size=4, block_words=block_words).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected(docs, items, 4)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, " ".join(f"P{i}" for i in range(5, 25))), (2, "nobody")]
    b = spark.createDataFrame(items, "item_id long, text string")
    want = expected([(r.doc_id, r.text) for r in odd_docs.collect()], items, 10)
    assert sorted([tuple(r) for r in contamination(odd_docs, b).collect()], key=str) == want
    left = drop_contaminated(odd_docs, b)
    # every row by its own text: the one without an id that holds "nobody" goes too
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 3
    assert contamination(no_docs, b).count() == 0
    assert contamination(odd_docs, b.filter("false")).filter("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one x two three"), (2, "three two one"), (3, "one x y z two three")], "doc_id long, text string")
    index = build_index(docs)
    hits = {r.doc_id: r.hit for r in search_index(index, [("7", "one two three")], 10, slop=1).collect()}
    assert hits == {1: [0, 2, 3], 2: [], 3: []}
    assert {r.doc_id: r.items for r in search_index(index, [("7", "one two three")], 10, slop=4).collect()} == {1: ["7"], 2: ["7"], 3: ["7"]}


def test_rows_are_judged_by_their_own_text(spark):
    docs = spark.createDataFrame([(1, "a clean one", "x"), (1, "has the phrase here", "y"), (None, "the phrase", "z"), (None, "clean", "z")],
                                 "doc_id long, text string, gone string").withColumn("digest", F.lit("own"))
    b = spark.createDataFrame([(1, "the phrase")], "item_id long, text string")
    left = drop_contaminated(docs, b)
    assert left.columns == docs.columns
    assert sorted(r.text for r in left.collect()) == ["a clean one", "clean"] and {r.digest for r in left.collect()} == {"own"}


def test_long_items_are_cut_without_losing_phrases(spark):
    rng = random.Random(8)
    item = " ".join(f"w{rng.randrange(300)}" for _ in range(900))
    docs = [(i, " ".join(item.split()[i * 7 : i * 7 + 15])) for i in range(120)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = contamination(d, b, block_words=400).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected(docs, [(1, item)], 10)
