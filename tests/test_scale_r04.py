"""Tables that jobs use again and again are worked out once; decoding holds a bounded slice."""

import datetime as dt

import pyarrow as pa
import yaml

from keelson.operators import context as W
from keelson.operators import graph as G
from keelson.sources import taskfiles as TF
from keelson.sources.bind import BINDINGS, Fleet

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
TASKS = "project string, task_id string, title string, status string, priority int, label string, seq long"


def counted(spark, rows, schema):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, schema).coalesce(1).mapInArrow(count, schema), seen


def test_read_once_gives_the_bound_rows_from_one_reading(spark):
    day = dt.datetime(2000, 1, 1)
    rows = [(k if k != 9 else None, [1, 2, None][k % 3], "FOP"[k % 3], day + dt.timedelta(days=k), "1-URGENT") for k in range(20)]
    orders, seen = counted(spark, rows, ORDERS)
    f = Fleet(spark, "/none", {"orders": orders}).read_once(deps=True)
    got = {n: sorted(map(tuple, f.table(n).collect()), key=str) for n in ("tasks", "task_deps")}
    assert seen.value == len(rows)
    plain = spark.createDataFrame(rows, ORDERS)
    tasks = spark.sql(BINDINGS["tasks"], orders=plain)
    assert got["tasks"] == sorted(map(tuple, tasks.collect()), key=str)
    assert got["task_deps"] == sorted(map(tuple, spark.sql(BINDINGS["task_deps"], tasks=tasks).collect()), key=str)


def graph(n=12):
    return ([("p", f"t{k:02}", "t", "open", 1, "low", k) for k in range(n)],
            [("p", f"t{k:02}", f"t{k - 2:02}") for k in range(2, n)])


def test_parallel_tracks_and_graph_tree_read_tasks_once(spark):
    tasks, deps = graph()
    d = spark.createDataFrame(deps, "project string, child string, parent string")
    for job, col, want in ((G.parallel_tracks, "track", lambda k: f"t{k % 2:02}"), (G.graph_tree, "parents", lambda k: [f"t{k - 2:02}"] if k > 1 else [])):
        t, seen = counted(spark, tasks, TASKS)
        got = {r["task_id"]: (r["level"], r[col]) for r in job(t, d).collect()}
        assert got == {f"t{k:02}": (k // 2 + 1, want(k)) for k in range(12)}
        assert seen.value <= 2 * len(tasks)        # the range bounds are sampled in a reading of their own


def test_pagerank_ends_with_the_longest_way(spark, monkeypatch):
    tasks, deps = graph(6)
    calls, was = [], G.cut_round
    monkeypatch.setattr(G, "cut_round", lambda df, r, **k: calls.append(r) or was(df, r, **k))
    d = spark.createDataFrame(deps, "project string, child string, parent string")
    got = {r["task_id"]: r["rank"] for r in G.pagerank(spark.createDataFrame(tasks, TASKS), d).collect()}
    assert calls == [1, 2, 3]                      # ways of two edges at most
    assert abs(sum(got.values()) - 1) < 1e-9 and got["t00"] > got["t02"] > got["t04"]


def test_project_health_reads_edges_in_few_passes(spark):
    tasks = [("p", "a", "t", "open", 1, "l", 1), ("p", "a", "t", "closed", 1, "l", 2), ("p", "b", "t", "open", 1, "l", 3),
             ("p", None, "t", "open", 1, "l", 4), ("p", "c", "t", "in_progress", 1, "l", 5), (None, "z", "t", "open", 1, "l", 6)]
    deps, seen = counted(spark, [("p", "b", "c"), ("p", "a", "b"), ("p", "c", "x")], "project string, child string, parent string")
    got = {r["project"]: r for r in G.project_health(spark.createDataFrame(tasks, TASKS), deps).collect()}
    p = got["p"]
    assert (p["n_tasks"], p["ready_ratio"], p["blocked_ratio"], p["depth"]) == (5, 0.2, 0.4, 3)
    assert got[None]["ready_ratio"] == 0.0
    assert seen.value <= 3 * 6                     # numbering is sampled and then read


def test_files_are_rendered_from_one_reading_of_the_tasks(spark):
    rows = [("p", f"bd-{k}", "T", "closed", 1, ["high", "low", None][k % 3], k) for k in range(1, 13)]
    tasks, seen = counted(spark, rows, TASKS)
    deps = spark.createDataFrame([("p", "bd-12", "bd-1")], "project string, child string, parent string")
    updated = spark.createDataFrame([("p", "bd-1", dt.date(2000, 1, 2))], "project string, task_id string, updated_on date")
    docs = {r["path"]: r["text"] for r in TF.render_task_docs(tasks, deps, updated, per_file=6).collect()}
    assert seen.value == len(rows)
    first = yaml.safe_load(docs["tasks/p/0.yaml"])
    # phases in the order of their first tasks; the phase without a label counts, but is not written
    assert [ph["name"] for ph in first["phases"]] == ["Phase 1: Low", "Phase 3: High"]
    assert first["updates"] == ["2000-01-02: closed bd-1"]


def test_decoding_holds_a_slice_of_a_batch(spark):
    texts = ["a: " + "x" * 400_000, None, "b: [", "c: 1"] * 4
    batch = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(16)], "text": texts})
    out = list(TF._decode_batches([batch]))
    assert len(out) > 1 and sum(b.num_rows for b in out) == 16
    docs = [d for b in out for d in b.column("doc").to_pylist()]
    errors = [e for b in out for e in b.column("error").to_pylist()]
    assert docs[3] == '{"c": 1}' and docs[1] is None and errors[1].startswith("ValueError") and errors[2] and errors[0] is None


def test_commit_references_are_matched_once_a_pattern(spark):
    rows = [("p", "b", "1", "bd-1: x"), ("p", "b", "2", "[q.1] y"), ("p", "b", "3", "z\n\nBead: bd-2"), ("p", "b", "4", "no bd-3: "), ("p", "b", "5", None)]
    commits = spark.createDataFrame(rows, "project string, branch string, sha string, subject string")
    tasks = spark.createDataFrame([("p", "bd-1", "t", "open", 1, "l", 1)], TASKS)
    out = W.commit_task_links(commits, tasks)
    assert {(r["sha"], r["task_id"], r["task_found"]) for r in out.collect()} == {("1", "bd-1", True), ("2", "q.1", False), ("3", "bd-2", False)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") <= 2 * len(W.COMMIT_REF_PATTERNS)


def test_only_checked_out_branches_are_summed_up(spark):
    changes = spark.createDataFrame([("p", "a", 1), ("p", "b", 2), ("q", "a", 3), (None, "a", 4)], "project string, branch string, n int")
    checkouts = spark.createDataFrame([("p", "a"), ("q", "b")], "project string, branch string")
    assert [r["n"] for r in W.of_branches(changes, checkouts).collect()] == [1]


def test_files_load_as_yaml_loads_them():
    texts = ["a: 1", "a: [x, 2, yes, 2001-01-01, ~, 1.5, {b: c, 3: d}]", "a: &x [1]\nb: *x", "<<: {a: 1}\nb: 2", "a: 1\na: b", "- x", "", "a: !!set {x, y}",
             "? [k]\n: v", "? {k: v}\n: v", "a: !t x", "a: b\n---\nc: d", "a: !!str 5", "a: !!int '5'", "=: x", "a: {=: 3}", "b: [", "a: !!seq x", "x: !!binary aGk=",
             "a: |\n  l1\n  l2\n", "a: \"q\\n\"", "\t", "a: *nope", "a: !!map [1]", "a: !!float 3", "2020-01-01: z", "a: &y\n  b: *y"]

    def result(load):
        try:
            return repr(load())
        except Exception as e:  # noqa: BLE001
            return f"{type(e).__name__}: {e}"
    for t in texts:
        assert result(lambda: TF._load(t, yaml, yaml.CSafeLoader)) == result(lambda: yaml.load(t, Loader=yaml.CSafeLoader)), t
