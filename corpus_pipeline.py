"""Training-corpus pipeline over ``documents``: each stage is one operator of
``keelson.llm``; its result is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import decontaminate, jaccard_join, mixing, pii, quality
from keelson.llm.common import scratch, table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (10): documents that it rejects go."""
    ratings = quality.grades_of(table(spark, sf_dir, "labels"))
    return quality.select(docs, quality.train(docs, ratings, 3))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (3): one document of each near-duplicate group stays."""
    return jaccard_join.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (9): passages of items are cut out; a document
    that is mostly benchmark goes."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (8): every span is replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights (7): all sources weigh the same; documents
    are repeated by their Poisson counts and shuffled."""
    return mixing.replicate(docs)


STAGES = [
    ("quality_classifier", select_quality),
    ("jaccard_join", one_of_each_group),
    ("decontamination", remove_benchmark),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]

#: The quality stage learns weights, which SQL can't state; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. Tables between stages go to the shared
    checkpoint folder, so a lost executor costs its tasks and no earlier stage."""
    docs = table(spark, sf_dir, "documents")
    home = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{home}/{k}-{name}")
            docs = spark.read.parquet(f"{home}/{k}-{name}")
    return docs
