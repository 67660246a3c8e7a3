import os
import sys

import pytest
from compare import compare
from pyspark.sql import functions as F

TINY = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.mark.parametrize("name", [
    "op3_de_bruijn_repeats", "op4_url_cascade", "op5_positional_index", "op8_exact_dedup",
    "op11_threshold_negatives", "op12_radix_suffixes", "op13_dawg_repair",
])
def test_against_sql(spark, name):
    from trajspark.llm.queries import ORACLES, QUERIES

    assert compare(QUERIES[name](spark, TINY), ORACLES[name], TINY) == ""


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    from trajspark.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline_stages(spark):
    import corpus_pipeline
    from trajspark.llm.decontamination import contamination
    from trajspark.llm.exact_dedup import exact_duplicates
    from trajspark.llm.simhash import near_duplicates

    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    names, columns, before = [n for n, _ in corpus_pipeline.STAGES], docs.columns, docs
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name.replace(' ', '-')}"
        stage(spark, before, TINY).write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns
        assert after.join(before, columns, "left_anti").count() == 0
        assert 0 < after.count() <= before.count()
        if name == "exact dedup":
            assert exact_duplicates(after).filter("group_size > 1").count() == 0
        if name == "SimHash near-dedup":
            assert near_duplicates(before).select("component_id").distinct().count() == after.count()
            assert near_duplicates(after).groupBy("component_id").count().filter("count > 1").count() == 0
        if name == "benchmark decontamination":
            judged = contamination(before, spark.read.parquet(f"{TINY}/benchmark.parquet"))
            assert {r.doc_id for r in judged.filter("not contaminated").collect()} == {r.doc_id for r in after.collect()}
        before = after
    assert corpus_pipeline.STAGES[-1][1](spark, before, TINY).count() == before.count()


def test_pipeline_stages_on_odd_rows(spark, odd_docs, no_docs):
    import corpus_pipeline

    docs = odd_docs.withColumns({"digest": F.lit("d"), "gone": F.lit("g"), "copies": F.lit(1), "name": F.lit("n"), "meta_0": F.lit(0), "held": F.lit(1)})
    for source in (docs, docs.filter("false")):
        before = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-{name.replace(' ', '-')}-{source is docs}"
            stage(spark, before, TINY).write.mode("overwrite").parquet(path)
            before = spark.read.parquet(path)
            assert before.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, before, TINY).count() == before.count()
    assert before.count() == 0
