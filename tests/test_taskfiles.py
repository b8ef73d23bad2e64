"""Task-file scan / decode / flatten (T1–T11, T14–T16) on hand-written files
covering the three layouts, fallbacks and a broken file."""

import os

from conftest import rows

from keelson.operators import validate as V
from keelson.sources import taskfiles as TF

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def _load(spark):
    files = TF.scan_task_docs(spark, os.path.join(FIX, "*.yaml"))
    dec = TF.decode_task_docs(files).cache()
    return files, dec, TF.flatten_tasks(dec).cache()


def _by_file(df, col="path"):
    return {os.path.basename(r[col]) for r in df.select(col).collect()}


def test_decode_keeps_bad_files(spark):
    _, dec, _ = _load(spark)
    bad = {os.path.basename(r.path) for r in dec.filter("error IS NOT NULL").collect()}
    assert bad == {"broken.yaml"}


def test_phases_layout(spark):
    _, _, t = _load(spark)
    p = t.filter(t.path.endswith("phases.yaml")).orderBy("idx")
    got = rows(p, "project", "task_id", "title", "priority", "status", "label", "idx")
    assert got == [
        ("demo", "setup-repo", "Set up the repository", 0, "closed", "1", 0),
        ("demo", "setup-ci", "Configure CI", 1, "in_progress", "1", 1),
        ("demo", "task-2", "No id here", 2, "open", "1", 2),
        ("demo", "build-api", "Only a description", 2, "open", "2", 3),
    ]


def test_flat_layout(spark):
    _, _, t = _load(spark)
    f = t.filter(t.path.endswith("flat.yaml")).orderBy("idx")
    assert rows(f, "project", "task_id", "title", "priority", "status", "label") == [
        ("flatproj", "api-one", "First", 3, "closed", "api"),
        ("flatproj", "plain", "Unnamed task", 1, "open", "default"),
        ("flatproj", "task-2", "unnamed id", 2, "open", "task"),
    ]


def test_keyed_layout_sorted_as_text(spark):
    _, _, t = _load(spark)
    k = t.filter(t.path.endswith("keyed.yaml")).orderBy("idx")
    # 'phase10_late' sorts before 'phase2_mid' (text order, as the source does)
    assert rows(k, "project", "task_id", "title", "priority", "status", "label") == [
        ("keyedproj", "k-late", "Late task", 3, "open", "late-phase"),
        ("keyedproj", "k-mid", "from a meta-free key", 0, "closed", "mid"),
    ]


def test_edges_drop_unknown_parents(spark):
    _, _, t = _load(spark)
    e = TF.dependency_edges(t)
    got = sorted((r.child, r.parent) for r in e.collect())
    assert got == [("build-api", "setup-ci"), ("k-mid", "k-late"), ("plain", "api-one"),
                   ("setup-ci", "setup-repo"), ("task-2", "setup-ci")]
    v = V.dangling_dependencies(t)
    assert [(r.task_id, r.detail) for r in v.collect()] == [("task-2", "missing-task")]


def test_migration_actions_order(spark):
    _, _, t = _load(spark)
    t = t.filter(t.path.endswith("phases.yaml"))
    a = TF.migration_actions(t, TF.dependency_edges(t)).orderBy("step", "idx", "dep_pos")
    assert [(r.action, r.task_id) for r in a.collect()] == [
        ("create", "setup-repo"), ("create", "setup-ci"), ("create", "task-2"), ("create", "build-api"),
        ("add_dependency", "setup-ci"), ("add_dependency", "task-2"), ("add_dependency", "build-api"),
        ("close", "setup-repo")]


def test_external_updates_and_counts(spark):
    files, dec, _ = _load(spark)
    ext = TF.external_dependencies(dec)
    assert sorted(rows(ext, "ext_project", "task")) == [("other", "lib-1"), ("other", "lib-2")]
    up = TF.update_log(dec).orderBy("pos")
    assert [(str(r.date), r.text) for r in up.collect()] == [("2024-01-02", "started"), ("None", "no date here")]
    cnt = {os.path.basename(r.path): r.approx_tasks for r in TF.approx_task_count(files).collect()}
    # 11 matching lines (the metadata description counts too) -> 5; flat: 4 -> 2
    assert cnt["phases.yaml"] == 5 and cnt["flat.yaml"] == 2


def test_validation_rules(spark):
    _, _, t = _load(spark)
    v = V.validate_files(t)
    rules = {(r.rule, r.task_id) for r in v.collect()}
    assert ("V3_priority", "task-2") in rules and ("V3_status", "task-2") in rules
    assert ("V2_missing_field", "task-2") in rules
    assert ("V4_unknown_dependency", "task-2") in rules


def test_write_tasks(spark, tmp_path):
    _, _, t = _load(spark)
    out = str(tmp_path / "tasks")
    TF.write_tasks(t.drop("dependencies"), out, "json")
    back = spark.read.json(out)
    assert back.count() == t.count()
    assert "project" in back.columns
