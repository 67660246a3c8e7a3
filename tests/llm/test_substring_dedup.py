import hashlib
import random
import re

from trajspark.llm.substring_dedup import remove_repeats, repeated_paths


def expected(docs, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - size + 1):
                key = tuple(w[p : p + size])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for p in range(len(w) - size + 1):
                if first[tuple(w[p : p + size])] < i:
                    gone.update(range(p, p + size))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_random_texts(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4)] + ["Ä", "x" * 40]
    passages = [" ".join(rng.choices(words, k=rng.randint(10, 40))) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 20))) for _ in range(4)]
        docs.append((i, "\n".join(parts)))
    docs += [(5, docs[5][1]), (None, docs[0][1]), (70, None), (71, ""), (72, "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for size, minimizer in ((6, 3), (13, 6)):
        got = remove_repeats(table, window=size, minimizer=minimizer).collect()
        assert sorted([tuple(r) for r in got], key=str) == expected(docs, size)


def test_odd_rows(odd_docs, no_docs):
    want = expected([(r.doc_id, r.text) for r in odd_docs.collect()], 13)
    assert sorted([tuple(r) for r in remove_repeats(odd_docs).collect()], key=str) == want
    assert remove_repeats(no_docs).count() == 0


def test_paths_are_compacted(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    docs = [(1, "a b " + shared + " c d"), (2, shared + " e"), (3, "f g " + " ".join(f"s{i}" for i in range(20)) + " h i j")]
    paths = repeated_paths(spark.createDataFrame(docs, "doc_id long, text string"), window=5, minimizer=3).collect()
    assert [(r.n_windows, r.source, r.source_place) for r in paths] == [(26, 1, 2)]


def test_paths_end_where_documents_part(spark):
    stem, left, right = (" ".join(f"{c}{i}" for i in range(12)) for c in "slr")
    docs = [(1, f"{stem} {left}"), (2, f"{stem} {left}"), (3, f"{stem} {right}"), (4, f"{stem} {right}")]
    paths = repeated_paths(spark.createDataFrame(docs, "doc_id long, text string"), window=5, minimizer=3).collect()
    assert sorted(r.n_windows for r in paths) == [8, 12, 12]
