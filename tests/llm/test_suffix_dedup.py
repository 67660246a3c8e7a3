import hashlib

import pytest

from trajspark.llm.suffix_dedup import remove_repeated_windows


def brute(rows, length):
    """Every window of every document in order of (id, start); a byte goes when its window was there before."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(data[i : i + length])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, length=100, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = remove_repeated_windows(df, length=length, **options)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}


def hand_made():
    import random

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéß中", k=rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    passage, line = prose(40), prose(18)
    rows = [(1, prose(300)), (2, None), (3, ""), (4, "short"), (5, "x" * 400), (6, "ab" * 300)]
    rows += [(10 + i, prose(20) + passage + prose(20)) for i in range(25)]
    rows += [(50 + i, prose(3) + line + prose(3) + line + "!") for i in range(12)]
    rows += [(70, rows[0][1]), (71, rows[0][1][:700] + "?" + rows[0][1][701:]), (72, rows[0][1][37:900]), (73, "y" * 99), (74, "y" * 100), (75, "y" * 101)]
    long = prose(9000)
    return rows + [(80, long), (81, prose(50) + long[1000:60_000] + prose(50)), (82, long[-5000:] + long[:5000])]


@pytest.mark.parametrize(("length", "rows_a_task"), [(100, 400_000), (100, 600), (13, 4000)])
def test_against_all_windows(spark, length, rows_a_task):
    rows = hand_made()
    assert run(spark, rows, length, rows_a_task=rows_a_task) == brute(rows, length)


def test_a_window_shared_by_many_texts_crosses_partitions(spark):
    import random

    rng = random.Random(3)
    line = "".join(rng.choices("abcdefgh ", k=130))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=60)) + line + "".join(rng.choices("abcdefgh ", k=60))) for i in range(400)]
    found = run(spark, rows, rows_a_task=40)
    assert found == brute(rows, 100)
    assert sum(v[1] >= 130 for v in found.values()) > 390


def test_odd_rows(spark, odd_docs, no_docs):
    assert remove_repeated_windows(no_docs).count() == 0
    rows = remove_repeated_windows(odd_docs, keep_text=True).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_removed for r in by[9]] == [0, 0] and by[3][0].n_bytes == 0
    assert by[8][0].n_removed == by[7][0].n_bytes + 1 and bytes(by[8][0].kept) == b"end"


def test_repeated_rows_are_one_document(spark):
    import random

    text = "".join(random.Random(1).choices("abcdefghij", k=300))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeated_windows(df).collect())
    assert found == [(0, 0), (1, 300), (1, 300), (2, 300)]
