"""A training corpus from ``documents``: good, unique, free of benchmark passages, tokenized.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of ``documents``; the last returns
their tokens. Stages read only what the one before wrote, so a lost executor repeats one stage at most.

Defined results: rows repeated with one id and text are exact copies; rows are judged by their own text, so null and repeated ids go through like
others; extra columns pass, whatever their names, and the last stage leaves them out; an empty table passes all stages. Labels that are missing keep
everything (see ``trajspark.llm.quality``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trajspark.llm.byte_bpe import token_digests
from trajspark.llm.common import read_table, saved
from trajspark.llm.decontamination import drop_contaminated
from trajspark.llm.exact_dedup import drop_exact_duplicates
from trajspark.llm.quality import keep_good, train
from trajspark.llm.simhash import drop_near_duplicates


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    return keep_good(docs, train(docs, read_table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked by at most 4 differing bits (4-word shingles), the document with the smallest id."""
    return drop_near_duplicates(docs, shingle=4, bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark phrase."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokens),
]

#: No SQL: the first stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
