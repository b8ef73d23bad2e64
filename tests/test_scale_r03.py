"""Commits of checked-out branches: gone through twice, read from there on."""

from pyspark.sql import functions as F

from keelson.operators import context as W

CHANGES = "project string, branch string, sha string, ts long, on_base boolean"


def test_branch_commits_reads_commits_twice(spark):
    rows = [("p", "a", "s1", 1, False), ("p", "a", "s2", 2, True), ("p", "b", "s1", 1, True), ("p", "a", "s3", 3, False),
            ("p", "c", "s4", 1, False), ("q", "a", "s5", 1, True), ("q", "a", "s6", 2, True), ("q", "a", "s3", 3, None), ("p", None, "s7", 1, False)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    changes = spark.createDataFrame(rows, CHANGES).coalesce(1).mapInArrow(count, CHANGES)
    commits = changes.groupBy("project", "branch", "sha").agg(F.max("ts").alias("ts"), F.bool_and("on_base").alias("on_base")).withColumn("subject", F.lit("x"))
    checkouts = spark.createDataFrame([("p", "a"), ("q", "a")], "project string, branch string")
    out = W.branch_commits(commits, checkouts, k=1)
    got = sorted((r["project"], r["sha"], r["kind"]) for r in out.collect())
    # s1 is on the base of p by branch b; q's s3 is on no base
    assert got == [("p", "s3", "ahead_of_base"), ("q", "s3", "ahead_of_base")]
    assert seen.value <= 2 * len(rows)
