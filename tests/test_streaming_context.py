"""Stateful stream at a cap that fires, diff sections and their truncation, graph methods."""

from pyspark.sql import functions as F

from keelson.operators import context as W
from keelson.operators import coord as M
from keelson.sources.bind import Fleet
from keelson.streaming import jobs as S

SF = "/root/testdata/sf0.001"


def test_review_load_alarm_matches_batch(spark):
    f = S.streaming_fleet(spark, SF)
    a = S.with_state_store(spark, lambda: S.run_stream(S.review_load_alarm(f.messages, cap=0), "review_load_test", "append"))
    b = S.passed_load_alarms(Fleet(spark, SF).messages, cap=0)
    got = sorted(map(tuple, a.collect()))
    assert got == sorted(map(tuple, b.select(*a.columns).collect()))
    assert 0 < len(got) <= M.review_load(Fleet(spark, SF).messages, cap=0).count()


def test_diff_sections_truncate(spark):
    rows = [("p", f"f{i:03d}.py", True, False, i, 1, 0, "@@ -1,0 +1,1 @@\n+x") for i in range(105)]
    rows += [("p", "g.py", False, True, 900, 1, 2, "@@ -1,2 +1,1 @@\n-a\n-b\n+x"), ("p", "g.py", False, True, 901, 80, 40, "@@ -9,0 +9,1 @@\n+y")]
    df = spark.createDataFrame(rows, "project string, path string, staged boolean, unstaged boolean, hunk_no long, insertions long, deletions long, hunk string")
    p = W.diff_sections(df, max_lines=100).first()
    # joined first (107 + 1 + 3 + 1 + 105 * 5 + 9 lines), then cut once
    assert p.n_lines == 646 and p.n_staged == 105 and p.n_unstaged == 1
    assert p.diff.startswith("Staged:\n f000.py | 1 +\n f001.py") and p.diff.endswith("f098.py | 1 +\n... (546 more lines)")
    whole = W.diff_sections(df, max_lines=1000).first().diff
    assert whole.count("\n") == 645
    assert "f104.py | 1 +\n 105 files changed, 105 insertions(+)\n\nUnstaged:\n g.py | 123 " + "+" * 39 + "-" * 20 in whole
    assert "1 file changed, 81 insertions(+), 42 deletions(-)\n\ndiff --git a/f000.py b/f000.py\n--- a/f000.py\n+++ b/f000.py\n@@ -1,0 +1,1 @@\n+x\ndiff" in whole
    assert whole.endswith("+++ b/g.py\n@@ -1,2 +1,1 @@\n-a\n-b\n+x\n@@ -9,0 +9,1 @@\n+y")


def test_dependent_counts_sketch_equals_exact(spark):
    from keelson.operators import graph as g

    f = Fleet(spark, SF)
    exact = {(r.project, r.task_id): r.transitive_dependents for r in g.blockers_to_clear(f.tasks, f.task_deps).collect()}
    sk = {(r.project, r.task_id): r.transitive_dependents
          for r in g.blockers_to_clear(f.tasks, f.task_deps, method="sketch").collect()}
    assert exact == sk and len(exact) > 0


def test_cycle_methods_agree(spark):
    from keelson.operators import graph as g

    f = Fleet(spark, SF)
    deps = f.task_deps.unionByName(f.back_edges)
    a = sorted(map(tuple, g.cycle_members(deps).collect()))
    b = sorted(map(tuple, g.cycle_members(deps, method="coloring").collect()))
    assert a == b and len(a) > 0
