"""Reservation overlap cases, graph loops on long chains and cycles, stream
restarts and late rows, and rows for every arm of the bindings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelson.operators import coord as M
from keelson.operators import graph as G
from keelson.operators import pulls as P
from keelson.plans.registry import JOBS
from keelson.sources.bind import Fleet
from keelson.streaming import jobs as S

T0 = dt.datetime(2024, 1, 1)
RES = "project string, reservation_id long, agent string, pattern string, exclusive boolean, start_ts timestamp_ntz, ttl_seconds long"


@pytest.mark.parametrize("a,b,overlap", [
    ("src/a.py", "src/b.py", False), ("src/a.py", "src/a.py", True), ("src/*.py", "src/*.go", False), ("**", "src/**", True),
    ("**/*.py", "src/x.py", True), ("*.md", "README.md", True), ("*.md", "docs/x.md", False), ("src/*/f1*.py", "src/m1/**", True),
    ("a/**/z.py", "a/b/c/z.py", True), ("a/**/z.py", "a/z.py", True), ("a/**/z.py", "a/y.py", False),
    ("app/[id]/**", "app/[id]/p.ts", True), ("app/[id]/**", "app/x/p.ts", False), ("src/m1/**", "src/m10/**", False),
    ("src/f?.py", "src/f10.py", False), ("src/f?.py", "src/f.py", False), ("src/?", "src/??", False), ("src/a*b*c", "src/axc", False),
    ("a/**/x/**/b", "a/y/b", False), ("src/**.py", "src/a/b.py", True), ("a*/x?/**", "ab/*y/z", True), ("a*c", "a?", True), ("a?c", "a*b", False),
])
def test_pattern_overlap(spark, a, b, overlap):
    rows = [("p", 1, "u1", a, True, T0, 600), ("p", 2, "u2", b, True, T0 + dt.timedelta(seconds=59), 100_000),
            ("q", 3, "u2", b, True, T0, 600), ("p", 4, "u1", a, True, T0 + dt.timedelta(days=9), 5)]
    got = M.reservation_conflicts(spark.createDataFrame(rows, RES)).collect()
    assert [(r["res_a"], r["res_b"]) for r in got] == ([(1, 2)] if overlap else [])


@pytest.mark.parametrize("pattern,n", [("README.md", 1), ("*.md", 1), ("**", 5), ("**/*.py", 2), ("c++/**", 1), ("app/[id]/**", 1)])
def test_file_hits(spark, pattern, n):
    files = spark.createDataFrame([("p", q, "u9") for q in ("README.md", "a/b.py", "c++/x", "app/[id]/p.ts", "b.py")],
                                  "project string, path string, agent string")
    active = spark.createDataFrame([("p", 1, "u1", pattern, True), ("p", 2, "u9", pattern, True)],
                                   "project string, reservation_id long, agent string, pattern string, exclusive boolean")
    got = M.file_conflicts(files, active).collect()
    assert len(got) == n and {r["agent"] for r in got} == {"u1"}     # one's own files are no conflict


def _graph(spark, edges, n):
    tasks = spark.createDataFrame([("p", f"t{i:05d}", f"T{i}", "open", 2, "x", i) for i in range(n)],
                                  "project string, task_id string, title string, status string, priority int, label string, seq long")
    deps = spark.createDataFrame([("p", f"t{c:05d}", f"t{p:05d}") for c, p in edges], "project string, child string, parent string")
    return tasks, deps


def test_long_chain_is_levelled_whole(spark):
    n = 18
    tasks, deps = _graph(spark, [(i, i - 1) for i in range(1, n)], n)
    lv = {r["task_id"]: r["level"] for r in G.task_levels(tasks, deps).collect()}
    assert lv == {f"t{i:05d}": i + 1 for i in range(n)}
    assert G.descendants(tasks, deps).count() == n * (n - 1) // 2
    counts = {r["task_id"]: r["transitive_dependents"] for r in G.dependent_counts(tasks, deps, max_words=1).collect()}
    assert counts == {f"t{i:05d}": n - 1 - i for i in range(n - 1)}
    comp = G.weak_components(tasks.select("project", "task_id"), deps.select("project", F.col("child").alias("a"), F.col("parent").alias("b")))
    assert comp.select("label").distinct().count() == 1


def test_cycle_methods_agree(spark):
    edges = [(i, (i + 1) % 12) for i in range(12)] + [(20, 0), (21, 20), (3, 30), (30, 31), (40, 40)]
    _, deps = _graph(spark, edges, 0)
    want = {f"t{i:05d}" for i in [*range(12), 40]}
    assert {r["task_id"] for r in G.cycle_members(deps).collect()} == want
    assert {r["task_id"] for r in G.cycle_members(deps, method="coloring").collect()} == want


def test_pagerank_against_plain_iteration(spark):
    edges = [(1, 0), (2, 0), (3, 1), (3, 2), (5, 4), (4, 5), (6, 0)]
    n, d = 8, 0.85
    tasks, deps = _graph(spark, edges, n)
    out = {c: [p for x, p in edges if x == c] for c in range(n)}
    r = [1 / n] * n
    for _ in range(20):
        lost = sum(r[i] for i in range(n) if not out[i])
        new = [(1 - d) / n + d * lost / n] * n
        for c, ps in out.items():
            for p in ps:
                new[p] += d * r[c] / len(ps)
        r = new
    got = {x["task_id"]: x["rank"] for x in G.pagerank(tasks, deps).collect()}
    assert all(abs(got[f"t{i:05d}"] - r[i]) < 1e-12 for i in range(n))


def test_checks_of_equal_numbers_stay_apart(spark):
    prs = spark.createDataFrame([("p", 1, "b", "MERGEABLE"), ("q", 1, "b", "MERGEABLE")], "project string, number long, head_ref string, mergeable string")
    checks = spark.createDataFrame([("p", 1, "ci", "COMPLETED", "FAILURE", "", 1), ("q", 1, "ci", "COMPLETED", "SUCCESS", "", 1)],
                                   "project string, number long, name string, status string, conclusion string, details_url string, seq long")
    reviews = spark.createDataFrame([("q", 1, "ann", "CHANGES_REQUESTED", 1)], "project string, number long, author string, state string, seq long")
    got = {r["project"]: r["issues"] for r in P.pr_issues(prs, checks, reviews, reviews.select("project", "number").limit(0)).collect()}
    assert got == {"p": ["**CI failures** - Fix: ci"], "q": ["**Changes requested** by @ann"]}


def _status(ids, start):
    return [(f"p{i % 3}", f"t{i % 5}", "open" if i % 2 else "closed", start + i, T0 + dt.timedelta(minutes=start + i)) for i in ids]


def test_stream_resumes_and_merges(spark, tmp_path):
    schema = "project string, task_id string, status string, event_id long, ts timestamp_ntz"
    src, home = str(tmp_path / "in"), str(tmp_path / "home")
    rows = _status(range(20), 0), _status(range(0, 20, 3), 100)
    frames = [spark.createDataFrame(r, schema) for r in rows]
    for k, f in enumerate(frames):
        f.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        got = S.run_stream(S.current_status(stream), "st", "update", ["project", "task_id"], home=home)
        want = S.current_status(frames[0] if k == 0 else frames[0].unionByName(frames[1]))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    again = S.run_stream(S.current_status(stream), "st", "update", ["project", "task_id"], home=home)   # nothing new
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_late_rows_are_dropped_by_the_hourly_stream(spark, tmp_path):
    schema = "name string, status string, conclusion string, run_id long, ts timestamp_ntz"

    def runs(hours, base):
        return [("ci", "COMPLETED", "FAILURE" if h % 2 else "SUCCESS", base + h, T0 + dt.timedelta(hours=h, minutes=5)) for h in hours]
    src = str(tmp_path / "in")
    for rows in (runs(range(0, 10), 0), runs([20, 21], 100), runs([3], 200), runs([30], 300)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = {r["window_start"]: r["runs"] for r in S.run_stream(S.check_failures_per_hour(files), "late", "append", home=str(tmp_path / "h")).collect()}
    hours = {(w - T0.replace(tzinfo=w.tzinfo)).total_seconds() / 3600: n for w, n in got.items()}
    assert set(hours) == set(range(0, 10)) | {20, 21} and hours[3] == 1   # the late run of hour 3 came after the watermark


def test_every_job_and_arm_has_rows(spark):
    sf = "/root/testdata/sf0.01"
    f = Fleet(spark, sf)
    kinds = {r[0] for r in M.classify_messages(f.messages).select("msg_kind").distinct().collect()}
    assert kinds == {"starting", "progress", "blocked", "complete", "review_request", "review_claimed", "review_complete",
                     "feedback_addressed", "re_review", "other"}
    for name in ("large_prs", "oversized_tasks", "review_load", "active_reservations", "file_conflicts", "duplicate_agent_names", "validate_drafts",
                 "stream_review_load", "context_loop", "reservation_conflicts"):
        assert not JOBS[name](spark, sf).isEmpty(), name
    assert {r[0] for r in JOBS["validate_drafts"](spark, sf).select("rule").distinct().collect()} == {
        "V1_duplicate_id", "V3_priority", "V3_status", "V8_not_kebab_case"}
    assert {r[0] for r in JOBS["loop_iterations"](spark, sf).select("issue").distinct().collect()} == {"gap", "repeat", "backwards"}
    assert {r[0] for r in JOBS["context_loop"](spark, sf).select("mode").distinct().collect()} == {"goal", "autopilot", "single"}
    assert {r[0] for r in JOBS["open_pr_by_branch"](spark, sf).select("state").distinct().collect()} == {"OPEN"}
    done = {(r["completed"], r["over_limit"]) for r in JOBS["loop_completion"](spark, sf).collect()}
    assert {True, False} == {c for c, _ in done} and {True, False} == {o for _, o in done}
    r = JOBS["draft_reconcile"](spark, sf).agg(F.sum("duplicates"), F.sum("status_mismatch"), F.sum("missing"), F.sum("extra")).first()
    assert all(x > 0 for x in r)
    assert JOBS["inbox_summary"](spark, sf).filter("mentions > 0").count() > 0
    assert JOBS["escalations"](spark, sf).filter("blocked_messages > 0").count() > 0
    assert JOBS["test_command_by_repo"](spark, sf).select("test_command").distinct().count() == 7
