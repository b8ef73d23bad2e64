"""Raw pull-request JSON, one document per PR and question, as the hosting
service answers: PR objects (or a list of one), check lists, nested reviews, and
review comments in either of two shapes. Rendered here from the fleet tables for
the registered decode jobs; in production the raw texts are collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PR = ["project", "number"]


def _lists(rows: DataFrame, order: str, item) -> DataFrame:
    """(project, number, items): the PR's items in order."""
    return rows.groupBy(*PR).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))).alias("l")).select(
        *PR, F.transform("l", lambda x: x["i"]).alias("items"))


def raw_prs(prs: DataFrame) -> DataFrame:
    """(project, raw): an object per PR; odd numbers stand in a list of one. A
    text that is no JSON, as a failed call prints, is added per conflicting PR."""
    body = F.to_json(F.struct(
        "number", "title", F.concat(F.lit("https://git.example/"), "project", F.lit("/"), F.col("number").cast("string")).alias("url"),
        "state", "mergeable", F.col("base_ref").alias("baseRefName"), F.col("head_ref").alias("headRefName")))
    rows = prs.select("project", F.when(F.col("number") % 2 == 1, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body).alias("raw"))
    failed = prs.filter(F.col("mergeable") == "CONFLICTING").select("project", F.lit("no pull requests found").alias("raw"))
    return rows.unionByName(failed)


def raw_checks(checks: DataFrame) -> DataFrame:
    """(project, number, raw): the PR's check list."""
    item = F.struct("name", "status", "conclusion", F.col("details_url").alias("detailsUrl"))
    return _lists(checks, "seq", item).select(*PR, F.to_json("items").alias("raw"))


def raw_reviews(reviews: DataFrame) -> DataFrame:
    """(project, number, raw): ``{"reviews": [{"author": {"login"}, "state", "body"}]}``."""
    item = F.struct(F.struct(F.col("author").alias("login")).alias("author"), "state", F.concat(F.lit("review "), F.col("seq").cast("string")).alias("body"))
    return _lists(reviews, "seq", item).select(*PR, F.to_json(F.struct(F.col("items").alias("reviews"))).alias("raw"))


def raw_comments(comments: DataFrame) -> DataFrame:
    """(project, number, raw): the PR's comments, under ``author`` or, from the
    other endpoint, under ``user`` (null fields are not written)."""
    login = F.struct(F.coalesce("author_login", "user_login").alias("login"))
    item = F.struct(F.when(F.col("author_login").isNotNull(), login).alias("author"),
                    F.when(F.col("author_login").isNull(), login).alias("user"), "body", "path", "line")
    return _lists(comments, "line", item).select(*PR, F.to_json("items").alias("raw"))
