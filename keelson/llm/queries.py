"""Registered queries of the training-data operators: ``opN_<name>`` applies
operator N, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import (centroids, decontaminate, filter_audit, jaccard_join, language_id, mixing, pii, quality,
                         secret_scan, toxicity, url_filter, warc_audit, winnowing)
from keelson.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_pairs(table(spark, sf_dir, "documents"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc_audit.audit(pages, warc_audit.faulty_replica(pages))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixing.replicate(docs)


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.grades_of(table(spark, sf_dir, "labels")), 3)
    return quality.grade(docs, model)


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


ORACLES["op4_warc_audit"] = warc_audit.ORACLE
ORACLES["op7_mixing"] = mixing.ORACLE
ORACLES["op11_filter_audit"] = filter_audit.ORACLE
ORACLES["op12_centroids"] = centroids.ORACLE
