"""PR issues (reference cases) and review-document parsing."""

from pyspark.sql import functions as F

from keelson.operators import coord as M
from keelson.operators import pulls as P

PR_SCHEMA = "project string, number bigint, head_ref string, mergeable string"
CHK = "project string, number bigint, name string, status string, conclusion string, details_url string, seq bigint"
REV = "project string, number bigint, author string, state string, seq bigint"
COM = "project string, number bigint, author_login string, user_login string, path string, line bigint, body string"


def issues(spark, prs, checks=(), reviews=(), comments=()):
    def of(rows, schema):                          # all in project p
        return spark.createDataFrame([("p", *r) for r in rows], schema)
    df = P.pr_issues(spark.createDataFrame(prs, PR_SCHEMA), of(checks, CHK), of(reviews, REV), of(comments, COM))
    return {r.number: (list(r.issues), r.merge_ready) for r in df.collect()}


def test_pr_issue_cases(spark):
    prs = [("p", n, f"b{n}", m) for n, m in [(1, "CONFLICTING"), (2, "MERGEABLE"), (3, "MERGEABLE"),
                                              (4, "MERGEABLE"), (5, "MERGEABLE"), (6, "MERGEABLE")]]
    checks = [(2, "test", "COMPLETED", "FAILURE", "", 1), (2, "lint", "COMPLETED", "FAILURE", "", 2),
              (2, "build", "COMPLETED", "SUCCESS", "", 3), (6, "slow", "IN_PROGRESS", "", "", 1)]
    reviews = [(3, "alice", "CHANGES_REQUESTED", 1), (3, "bob", "CHANGES_REQUESTED", 2), (5, "carol", "APPROVED", 1)]
    comments = [(4, "dan", None, "a.go", 3, "fix"), (4, None, "erin", "b.go", 0, "why")]
    got = issues(spark, prs, checks, reviews, comments)
    assert got[1] == (["**Merge conflicts** - Resolve conflicts with the base branch"], False)
    assert got[2] == (["**CI failures** - Fix: test, lint"], False)
    assert got[3] == (["**Changes requested** by @alice"], False)
    assert got[4] == (["**2 review comment(s)** to address"], False)
    assert got[5] == ([], True)
    assert got[6] == (["**1 check(s) still running** - Wait for completion"], False)


def test_comment_shapes_and_quotes(spark):
    c = spark.createDataFrame([("p", 4, "dan", None, "a.go", 3, "fix\nthis"), ("p", 4, None, "erin", "b.go", 0, "why")], COM)
    got = [(r.author, r.location, r.quoted) for r in P.comment_rows(c).orderBy("author").collect()]
    assert got == [("dan", "a.go:3", "> fix\n> this"), ("erin", "b.go", "> why")]


def test_decode_json(spark):
    raw = spark.createDataFrame([('{"number":42,"title":"Test PR","url":"u","state":"OPEN","mergeable":"MERGEABLE",'
                                  '"baseRefName":"main","headRefName":"feature/test"}',), ("not valid json",)], "raw string")
    got = P.decode_prs(raw).collect()
    assert [(r.number, r.headRefName) for r in got] == [(42, "feature/test")]
    chk = spark.createDataFrame([('[{"name":"a","status":"COMPLETED","conclusion":"SUCCESS","detailsUrl":"x"},'
                                  '{"name":"b","status":"QUEUED","conclusion":"","detailsUrl":""}]',)], "raw string")
    assert [(r.seq, r.name) for r in P.decode_checks(chk).collect()] == [(1, "a"), (2, "b")]


def test_nested_reviews_and_both_comment_shapes(spark):
    raw = spark.createDataFrame([("p", 7, '{"reviews":[{"author":{"login":"ann"},"state":"APPROVED","body":"ok"},'
                                  '{"author":{"login":"bob"},"state":"odd","body":""}]}'), ("p", 8, "oops")],
                                "project string, number bigint, raw string")
    got = [(r.number, r.seq, r.author, r.mark) for r in P.decode_reviews(raw).orderBy("seq").collect()]
    assert got == [(7, 1, "ann", "✅"), (7, 2, "bob", "•")]
    raw = spark.createDataFrame([("p", 7, '[{"author":{"login":"ann"},"body":"a\\nb","path":"x.go","line":3}]'),
                                 ("p", 8, '[{"user":{"login":"bob"},"body":"c","path":"y.go","line":0}]'), ("p", 9, "[")],
                                "project string, number bigint, raw string")
    got = [(r.number, r.author, r.location, r.quoted) for r in P.decode_comments(raw).orderBy("number").collect()]
    assert got == [(7, "ann", "x.go:3", "> a\n> b"), (8, "bob", "y.go", "> c")]


REVIEW = """## Review: bd-1-review

**Reviewer**: Kestrel
**Verdict**: Changes Requested

### Blocking Issues

1. **Security**: Token not validated
   - detail
2. **Bug**: wrong units

### Suggestions

3. Consider rate limiting
4. Better messages

### Questions

5. Why RS256?

### Nitpicks

6. Typo in comment
"""


def test_review_items_verdict_and_resolution(spark):
    posts = spark.createDataFrame([("p", "bd-1-review", 1, REVIEW)], "project string, thread_id string, msg_id bigint, body string")
    items = M.feedback_items(posts)
    cats = sorted((r.item_no, r.category) for r in items.collect())
    assert cats == [(1, "blocking"), (2, "blocking"), (3, "suggestion"), (4, "suggestion"),
                    (5, "question"), (6, "nitpick")]
    v = M.verdicts(posts, items).first()
    assert (v.stated, v.derived, v.consistent) == ("Changes Requested", "Changes Requested", True)
    fixes = spark.createDataFrame([("p", "bd-1-review", 2, "\n".join(f"- [x] #{i} done" for i in range(1, 7)))],
                                  "project string, thread_id string, msg_id bigint, body string")
    assert M.unresolved_feedback(items, M.resolutions(fixes)).count() == 0
    partial = fixes.withColumn("body", F.lit("- [x] #1 ok\n- [ ] #2 later"))
    assert M.unresolved_feedback(items, M.resolutions(partial)).count() == 5


def test_reservation_conflicts_prefix_and_time(spark):
    r = spark.createDataFrame([
        ("p", "a", "src/auth/**", "2024-01-01 10:00:00", 3600, True, 1),
        ("p", "b", "src/**", "2024-01-01 10:30:00", 600, False, 2),       # ancestor dir, overlaps -> conflict
        ("p", "c", "src/auth/**", "2024-01-01 12:00:00", 600, True, 3),   # no time overlap
        ("p", "a", "src/auth/x/**", "2024-01-01 10:35:00", 600, True, 4),  # same agent as 1; overlaps 2
        ("p", "d", "docs/**", "2024-01-01 10:00:00", 3600, True, 5),      # other tree
    ], "project string, agent string, pattern string, start_ts string, ttl_seconds bigint, exclusive boolean, "
       "reservation_id bigint").withColumn("start_ts", F.col("start_ts").cast("timestamp_ntz"))
    got = sorted((x.res_a, x.res_b) for x in M.reservation_conflicts(r).collect())
    assert got == [(1, 2), (2, 4)]
