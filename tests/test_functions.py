"""Row-level expressions against the literal cases of the reference tests."""

from pyspark.sql import functions as F

from keelson.functions import expr as X
from keelson.operators import context as W


def one_col(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_extract_task_id(spark):
    cases = {"feature/bd-123-add-feature": "bd-123", "bd-456": "bd-456", "feature/BEAD-789-fix": "BEAD-789",
             "main": "", "feature/some-feature": "", "hotfix/bead-42-urgent": "bead-42",
             "BEAD-1-bd-2": "bd-2"}
    df = one_col(spark, list(cases)).select("c", X.extract_task_id(F.col("c")).alias("id"))
    assert {r.c: r.id for r in df.collect()} == cases


def test_parse_list_line(spark):
    cases = {"bd-123  Some task title  [in_progress]": ("bd-123", "Some task title"),
             "bd-456  Another task": ("bd-456", "Another task"), "bd-789": ("bd-789", ""),
             "": ("", ""), "not a bead line": ("", "")}
    lid, title = X.parse_list_line(F.col("c"))
    got = {r.c: (r.i, r.t) for r in one_col(spark, list(cases)).select("c", lid.alias("i"), title.alias("t")).collect()}
    assert got == cases


def test_show_field(spark):
    df = one_col(spark, ["Title: Some task\nStatus: in_progress\nPriority: 1", "Status: open", ""])
    got = [(r.t, r.s) for r in df.select(X.show_field(F.col("c"), "Title").alias("t"),
                                         X.show_field(F.col("c"), "Status").alias("s")).collect()]
    assert got == [("Some task", "in_progress"), ("", "open"), ("", "")]


def test_count_lines(spark):
    cases = {"": 0, "one line": 1, "line1\nline2": 2, "a\nb\nc": 3, "line1\nline2\n": 2, "a\n\nb": 3}
    df = one_col(spark, list(cases)).select("c", X.count_lines(F.col("c")).alias("n"))
    assert {r.c: r.n for r in df.collect()} == cases


def test_truncate_lines(spark):
    df = one_col(spark, ["a\nb\nc\nd", "a\nb"]).select(X.truncate_lines(F.col("c"), 2).alias("t"))
    assert [r.t for r in df.collect()] == ["a\nb\n... (2 more lines)", "a\nb"]


def test_sanitize_and_slug(spark):
    df = one_col(spark, ["run (fast) `cmd` $HOME"]).select(X.sanitize(F.col("c")).alias("s"))
    assert df.first().s == "run [fast] 'cmd' HOME"
    df = one_col(spark, ["Phase 1: Setup", "  Hello, World!  "]).select(
        X.phase_label(F.col("c")).alias("p"), X.slugify(F.col("c")).alias("s"))
    assert [tuple(r) for r in df.collect()] == [("1", "phase-1-setup"), ("hello-world", "hello-world")]


def test_priority_status_codes(spark):
    df = one_col(spark, ["Critical", "high", "MEDIUM", "low", "urgent", None]).select(
        X.priority_code(F.col("c")).alias("p"))
    assert [r.p for r in df.collect()] == [0, 1, 2, 3, 2, 2]
    df = one_col(spark, ["pending", "in-progress", "in_progress", "completed", "done", "blocked", None]).select(
        X.status_code(F.col("c")).alias("s"))
    assert [r.s for r in df.collect()] == ["open", "in_progress", "in_progress", "closed", "closed", "open", "open"]


def test_check_category_and_labels(spark):
    df = spark.createDataFrame([("COMPLETED", "SUCCESS"), ("COMPLETED", "FAILURE"), ("IN_PROGRESS", ""),
                                ("COMPLETED", "SKIPPED"), ("COMPLETED", "NEUTRAL"), ("completed", "SUCCESS")],
                               "status string, conclusion string")
    got = [r.c for r in df.select(X.check_category(F.col("status"), F.col("conclusion")).alias("c")).collect()]
    assert got == ["passing", "failing", "pending", "passing", "passing", "pending"]
    m = one_col(spark, ["MERGEABLE", "conflicting", "UNKNOWN", "other"]).select(X.mergeable_label(F.col("c")).alias("m"))
    assert [r.m for r in m.collect()] == ["✅ Yes", "❌ Conflicts", "⏳ Checking...", "other"]
    s = one_col(spark, ["APPROVED", "CHANGES_REQUESTED", "COMMENTED", "PENDING", "DISMISSED", "x"]).select(
        X.review_state_mark(F.col("c")).alias("m"))
    assert [r.m for r in s.collect()] == ["✅", "❌", "💬", "⏳", "🚫", "•"]


def test_remote_status(spark):
    df = one_col(spark, ["## feature/test...origin/feature/test [behind 3]", "## b...o/b [ahead 2]",
                         "## b...o/b [ahead 1, behind 2]", "## main"])
    a, b, _ = W.remote_status(F.col("c"))
    assert [(r.a, r.b) for r in df.select(a.alias("a"), b.alias("b")).collect()] == [(0, 3), (2, 0), (1, 2), (0, 0)]


def test_status_counts_and_format(spark):
    lines = [("p1", "A "), ("p2", "MM"), ("p3", "??"), ("p4", "A "), ("p4", " M"), ("p4", "??"), ("p5", " M")]
    df = spark.createDataFrame(lines, "project string, xy string")
    got = {r.project: (r.staged, r.modified, r.untracked, r.status_text) for r in W.status_counts(df).collect()}
    assert got == {"p1": (1, 0, 0, "1 staged"), "p2": (1, 1, 0, "1 staged, 1 modified"),
                   "p3": (0, 0, 1, "1 untracked"), "p4": (1, 1, 1, "1 staged, 1 modified, 1 untracked"),
                   "p5": (0, 1, 0, "1 modified")}


def test_detect_test_command(spark):
    cases = {"a": ["go.mod"], "b": ["package.json"], "c": ["package.json", "yarn.lock"],
             "d": ["package.json", "pnpm-lock.yaml"], "e": ["pyproject.toml"], "f": ["setup.py"],
             "g": ["Cargo.toml"], "h": ["Makefile"], "i": ["README.md"]}
    df = spark.createDataFrame([(p, f) for p, fs in cases.items() for f in fs], "project string, path string")
    got = {r.project: r.test_command for r in W.detect_test_command(df).collect()}
    assert got == {"a": "go test ./... && go build ./...", "b": "npm test", "c": "yarn test", "d": "pnpm test",
                   "e": "pytest", "f": "pytest", "g": "cargo test && cargo build", "h": "make test",
                   "i": "# No test runner detected - verify manually or add tests"}


def test_relative_age(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:30"), ("2024-01-01 00:00:00", "2024-01-03 00:00:00"),
                                ("2024-01-01 00:00:00", "2024-03-01 00:00:00"), ("2020-01-01 00:00:00", "2024-01-01 00:00:00")],
                               "ts string, now string")
    got = [r.a for r in df.select(W.relative_age(F.col("ts"), F.col("now")).alias("a")).collect()]
    assert got == ["30 seconds ago", "2 days ago", "9 weeks ago", "4 years ago"]
