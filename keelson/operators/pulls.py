"""Pull-request and CI analytics.

A PR is identified by (project, number): numbers repeat across projects. Per-PR
facts are pre-aggregated on that key before they meet the PR table, so the
multi-way join in ``pr_issues`` never fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import expr as X
from keelson.operators.scan import ranked

# Issue texts of the source.
ISSUE_CONFLICTS = "**Merge conflicts** - Resolve conflicts with the base branch"
ISSUE_CI = "**CI failures** - Fix: "
ISSUE_CHANGES = "**Changes requested** by @"
ISSUE_COMMENTS = " review comment(s)** to address"
ISSUE_PENDING = " check(s) still running** - Wait for completion"

PR = ["project", "number"]

PR_JSON_SCHEMA = ("number BIGINT, title STRING, url STRING, state STRING, mergeable STRING, "
                  "baseRefName STRING, headRefName STRING")
CHECKS_JSON_SCHEMA = "ARRAY<STRUCT<name: STRING, status: STRING, conclusion: STRING, detailsUrl: STRING>>"


def decode_prs(raw: DataFrame, col: str = "raw") -> DataFrame:
    """P1 decode: JSON object or array text -> PR rows; invalid text -> no row."""
    arr = F.from_json(F.col(col), f"ARRAY<STRUCT<{PR_JSON_SCHEMA.replace(' BIGINT', ': BIGINT').replace(' STRING', ': STRING')}>>")
    obj = F.from_json(F.col(col), PR_JSON_SCHEMA)
    rows = raw.withColumn("_prs", F.when(F.trim(F.col(col)).startswith("["), arr)
                          .otherwise(F.when(obj.isNotNull() & obj.number.isNotNull(), F.array(obj))))
    return rows.select(*[c for c in raw.columns if c != col], F.explode("_prs").alias("pr")).select(
        *[c for c in raw.columns if c != col], "pr.*")


def decode_checks(raw: DataFrame, col: str = "raw") -> DataFrame:
    """Checks JSON array -> rows with their source position."""
    keep = [c for c in raw.columns if c != col]
    return (raw.select(*keep, F.posexplode(F.from_json(F.col(col), CHECKS_JSON_SCHEMA)).alias("seq", "c"))
            .select(*keep, (F.col("seq") + 1).cast("bigint").alias("seq"), "c.name", "c.status", "c.conclusion",
                    F.col("c.detailsUrl").alias("details_url")))


REVIEWS_JSON_SCHEMA = "reviews ARRAY<STRUCT<author: STRUCT<login: STRING>, state: STRING, body: STRING>>"
COMMENTS_JSON_SCHEMA = ("ARRAY<STRUCT<author: STRUCT<login: STRING>, user: STRUCT<login: STRING>, body: STRING, "
                        "path: STRING, line: BIGINT>>")


def decode_reviews(raw: DataFrame, col: str = "raw") -> DataFrame:
    """Nested reviews -> rows with their position, the flattened
    author, the upper-case state and the state's mark."""
    keep = [c for c in raw.columns if c != col]
    r = raw.select(*keep, F.posexplode(F.from_json(F.col(col), REVIEWS_JSON_SCHEMA)["reviews"]).alias("seq", "r"))
    return r.select(*keep, (F.col("seq") + 1).cast("bigint").alias("seq"), F.coalesce("r.author.login", F.lit("")).alias("author"),
                    F.col("r.state").alias("state"), X.review_state_mark(F.col("r.state")).alias("mark"),
                    F.col("r.body").alias("body"))


def decode_comments(raw: DataFrame, col: str = "raw") -> DataFrame:
    """Comment lists of both shapes (``author.login`` or ``user.login``) ->
    rows with one author, location and quoted body."""
    keep = [c for c in raw.columns if c != col]
    c = raw.select(*keep, F.posexplode(F.from_json(F.col(col), COMMENTS_JSON_SCHEMA)).alias("seq", "c"))
    return c.select(*keep, (F.col("seq") + 1).cast("bigint").alias("seq"),
                    F.coalesce("c.author.login", "c.user.login", F.lit("")).alias("author"),
                    F.col("c.path").alias("path"), F.col("c.line").alias("line"),
                    X.comment_location(F.col("c.path"), F.col("c.line")).alias("location"),
                    X.quoted_body(F.col("c.body")).alias("quoted"))


def existing_pr(prs: DataFrame) -> DataFrame:
    """One PR per (project, head branch): the open one with the highest
    number (``gh pr list --head b --limit 1`` lists open PRs)."""
    w = Window.partitionBy("project", "head_ref").orderBy(F.desc("number"))
    return (prs.filter(F.col("state") == "OPEN").withColumn("r", F.row_number().over(w))
            .filter("r = 1").drop("r"))


def branches_without_pr(branches: DataFrame, prs: DataFrame, base: DataFrame) -> DataFrame:
    """Branches that are not a base branch and have no open PR."""
    b = (branches.join(base, "project", "left")
         .filter(~F.col("branch").isin("main", "master") &
                 (F.col("branch") != F.coalesce(F.col("base_branch"), F.lit("main")))))
    open_heads = prs.filter(F.col("state") == "OPEN").select("project", F.col("head_ref").alias("branch"))
    return b.join(open_heads, ["project", "branch"], "left_anti").select("project", "branch", "base_branch")


def categorized_checks(checks: DataFrame) -> DataFrame:
    """Category per check row."""
    return checks.withColumn("category", X.check_category(F.col("status"), F.col("conclusion")))


def check_counts(checks: DataFrame) -> DataFrame:
    """P5: passing / failing / pending counts per PR."""
    c = categorized_checks(checks)
    return c.groupBy(*PR).agg(
        *[F.sum(F.when(F.col("category") == k, 1).otherwise(0)).cast("bigint").alias(k)
          for k in ("passing", "failing", "pending")],
        F.count(F.lit(1)).alias("total"))


def check_details(checks: DataFrame) -> DataFrame:
    """Failing and pending checks in source order (``seq``), one row each,
    with the display line the source prints."""
    c = categorized_checks(checks).filter(F.col("category") != "passing")
    line = (F.when(F.col("category") == "failing",
                   F.concat(F.lit("❌ "), F.col("name"),
                            F.when(F.coalesce(F.col("details_url"), F.lit("")) != "",
                                   F.concat(F.lit("\n   "), F.col("details_url"))).otherwise(F.lit(""))))
            .otherwise(F.concat(F.lit("⏳ "), F.col("name"))))
    return c.select(*PR, "category", "seq", "name", line.alias("line"))


def check_failure_rate(checks: DataFrame) -> DataFrame:
    """Runs, failures and failure rate per check name across the fleet,
    ranked by rate (completed runs only)."""
    c = categorized_checks(checks).filter(F.col("category") != "pending")
    agg = c.groupBy("name").agg(F.count(F.lit(1)).alias("runs"),
                                F.sum(F.when(F.col("category") == "failing", 1).otherwise(0)).cast("bigint").alias("failures"))
    agg = agg.withColumn("failure_rate", F.round(F.col("failures") / F.col("runs"), 6))
    return ranked(agg, [], [F.desc("failure_rate"), F.asc("name")])


def comment_rows(comments: DataFrame) -> DataFrame:
    """Comments of both shapes with one author, location and quoted body."""
    return comments.select(
        *PR, F.coalesce(F.col("author_login"), F.col("user_login"), F.lit("")).alias("author"),
        "path", "line", X.comment_location(F.col("path"), F.col("line")).alias("location"),
        X.quoted_body(F.col("body")).alias("quoted"))


def review_summary(reviews: DataFrame) -> DataFrame:
    """Per PR — review counts by state and the first reviewer (source
    order) who requested changes. The mark of each state is in ``decode_reviews``."""
    r = reviews.withColumn("u", F.upper("state"))
    return r.groupBy(*PR).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.when(F.col("u") == "APPROVED", 1).otherwise(0)).cast("bigint").alias("approved"),
        F.sum(F.when(F.col("u") == "CHANGES_REQUESTED", 1).otherwise(0)).cast("bigint").alias("changes_requested"),
        F.sum(F.when(F.col("u") == "COMMENTED", 1).otherwise(0)).cast("bigint").alias("commented"),
        F.min_by(F.when(F.col("u") == "CHANGES_REQUESTED", F.col("author")),
                 F.when(F.col("u") == "CHANGES_REQUESTED", F.col("seq"))).alias("first_change_requester"))


def review_share(reviews: DataFrame) -> DataFrame:
    """Reviews and approval share per reviewer, ranked."""
    a = reviews.groupBy("author").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.when(F.upper("state") == "APPROVED", 1).otherwise(0)).cast("bigint").alias("approvals"))
    a = a.withColumn("approval_share", F.round(F.col("approvals") / F.col("reviews"), 6))
    return ranked(a, [], [F.desc("reviews"), F.asc("author")])


def pr_issues(prs: DataFrame, checks: DataFrame, reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """Ordered issue list per PR and whether it is merge-ready.

    Conflicts; failing check names in source order; first changes-requested
    reviewer; comment count; pending checks only when nothing else applies.
    """
    cat = categorized_checks(checks)
    chk = cat.groupBy(*PR).agg(
        F.sum(F.when(F.col("category") == "failing", 1).otherwise(0)).alias("n_failing"),
        F.sum(F.when(F.col("category") == "pending", 1).otherwise(0)).alias("n_pending"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("category") == "failing", F.struct("seq", "name")))), lambda s: s["name"]), ", ")
        .alias("failing_names"))
    rev = reviews.withColumn("u", F.upper("state")).filter(F.col("u") == "CHANGES_REQUESTED").groupBy(*PR) \
        .agg(F.min_by("author", "seq").alias("requester"))
    com = comments.groupBy(*PR).agg(F.count(F.lit(1)).alias("n_comments"))
    p = (prs.select("project", "number", "head_ref", "mergeable")
         .join(chk, PR, "left").join(rev, PR, "left").join(com, PR, "left")
         .fillna(0, ["n_failing", "n_pending", "n_comments"]))
    base = F.array_compact(F.array(
        F.when(F.upper("mergeable") == "CONFLICTING", F.lit(ISSUE_CONFLICTS)),
        F.when(F.col("n_failing") > 0, F.concat(F.lit(ISSUE_CI), F.col("failing_names"))),
        F.when(F.col("requester").isNotNull(), F.concat(F.lit(ISSUE_CHANGES), F.col("requester"))),
        F.when(F.col("n_comments") > 0, F.concat(F.lit("**"), F.col("n_comments").cast("string"), F.lit(ISSUE_COMMENTS)))))
    issues = F.when((F.size(base) == 0) & (F.col("n_pending") > 0),
                    F.array(F.concat(F.lit("**"), F.col("n_pending").cast("string"), F.lit(ISSUE_PENDING)))
                    ).otherwise(base)
    return p.select("project", "number", "head_ref", X.mergeable_label(F.col("mergeable")).alias("mergeable_label"),
                    issues.alias("issues")).withColumn("merge_ready", F.size("issues") == 0)


def review_context(file_changes: DataFrame) -> DataFrame:
    """Per branch — commits ahead of base, files, insertions, deletions."""
    d = file_changes.filter(~F.col("on_base"))
    return d.groupBy("project", "branch").agg(
        F.countDistinct("sha").alias("commits"), F.countDistinct("path").alias("files"),
        F.sum("insertions").cast("bigint").alias("insertions"), F.sum("deletions").cast("bigint").alias("deletions"))


def large_prs(prs: DataFrame, file_changes: DataFrame, limit: int = 500) -> DataFrame:
    """PRs whose branch changes more than ``limit`` lines against base."""
    ctx = review_context(file_changes).withColumn("lines", F.col("insertions") + F.col("deletions"))
    return (prs.select("project", "number", F.col("head_ref").alias("branch"))
            .join(ctx, ["project", "branch"]).filter(F.col("lines") > limit))
