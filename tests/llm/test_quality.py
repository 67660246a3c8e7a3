import numpy as np
from pyspark.sql import functions as F

from trajspark.llm.quality import calibrate, fit_logistic, keep_good, score_documents, train

SF = "/root/testdata/sf0.1"


def test_accuracy_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(4)) == 0
    model = train(docs, labels.filter(~held), rounds=1)
    scored = score_documents(docs, model)
    judged = scored.join(labels.filter(held), "doc_id").withColumn("good", (F.col("quality") == 1) & (F.col("toxic") == 0))
    row = judged.agg(
        F.avg(F.when(F.col("good"), F.col("kept").cast("int"))).alias("kept_good"), F.avg((F.col("kept") == F.col("good")).cast("int")).alias("right"),
    ).first()
    assert row.kept_good >= 0.98
    assert row.right >= 0.93
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in scored.filter("kept").collect()}


def test_odd_rows(spark, odd_docs, no_docs):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (7, 1, None), (9, None, None), (None, 0, 0), (99, 0, 1)], schema)
    model = train(odd_docs, labels, rounds=1)
    scored = score_documents(odd_docs, model).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert keep_good(odd_docs, model).columns == odd_docs.columns
    nobody = train(odd_docs, spark.createDataFrame([], schema))
    assert all(r.kept for r in score_documents(odd_docs, nobody).collect())
    assert score_documents(no_docs, nobody).count() == 0
    assert keep_good(no_docs, train(no_docs, labels)).count() == 0


def test_logistic_and_calibration_find_the_odds():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (8000, 3)).astype(np.float32)
    odds = rows @ np.array([2.0, -1.0, 0.0]) - 0.5
    bad = (rng.random(8000) < 1 / (1 + np.exp(-odds))).astype(float)
    assert np.abs(fit_logistic(rows, bad) - [2, -1, 0, -0.5]).max() < 0.25
    scores = np.linspace(-4, 4, 41)
    share = 1 / (1 + np.exp(-(0.5 * scores + 1)))
    scale, shift = calibrate(scores, share * 1000, np.full(41, 1000.0))
    assert abs(scale - 0.5) < 0.02 and abs(shift - 1) < 0.02


def test_views_teach_each_other(spark):
    """Half of the bad documents show it in their words, half in their source, and labels tell of few: each view learns the other's half."""
    rng = np.random.default_rng(4)
    common = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(6000):
        bad = rng.random() < 0.4
        words = list(rng.choice(common, 30))
        # every bad document has a mark in both views; labelled ones show a view's mark only with those the other can't see
        style, place = rng.integers(0, 6), rng.integers(0, 6)
        if bad:
            words += [f"spam{style}"] * 2
        rows.append((i, " ".join(words), "en", f"farm{place}" if bad else f"press{place}", 200, bad, int(style)))
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    # only words spam0 and spam1 occur among the labelled
    labels = spark.createDataFrame([(r[0], 0 if r[5] else 1, 0) for r in rows if r[0] % 3 == 0 and (not r[5] or r[6] < 2)], "doc_id long, quality int, toxic int")
    model = train(docs, labels, pool_rows=1500, given=600)
    assert {(view, bad) for _, view, bad, n, trust in model.handed if n and trust > 0.5} >= {("meta", True), ("meta", False), ("text", True)}
    scored = {r.doc_id: r for r in score_documents(docs, model).collect()}
    alone = train(docs, labels, rounds=0)
    before = {r.doc_id: r for r in score_documents(docs, alone).collect()}
    hidden = [r for r in rows if r[5] and r[6] >= 2]

    def told(found):
        return np.mean([found[r[0]].text_score < 0.5 for r in hidden])

    assert all(len(h) == 5 for h in model.handed) and len({h[0] for h in model.handed}) == 2
    assert np.mean([not scored[r[0]].kept for r in rows if r[5]]) > 0.95
    assert told(scored) >= told(before)


def test_bounds_hold_for_repeated_ids(spark):
    docs = spark.createDataFrame([(i % 40, f"good words {i}" if i % 2 else f"bad spam {i}", "en", "s", 10) for i in range(4000)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    model = train(docs, labels, label_rows=20, pool_rows=10, given=4)
    assert score_documents(docs, model).count() == 4000
