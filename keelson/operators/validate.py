"""Validation rules over task tables.

Every rule returns violation rows ``(project, rule, task_id, detail)``;
``validate_all`` is their ``unionByName``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators.scan import running

# Enums of the task-file format.
PRIORITY_ENUM = ["critical", "high", "medium", "low"]
STATUS_ENUM = ["pending", "in-progress", "completed", "blocked"]
KEBAB = r"^[a-z0-9]+(-[a-z0-9]+)*$"
REQUIRED = ["id", "name", "description", "priority", "status"]


def _v(df: DataFrame, rule: str, detail) -> DataFrame:
    return df.select("project", F.lit(rule).alias("rule"), "task_id", detail.alias("detail"))


def duplicate_ids(tasks: DataFrame) -> DataFrame:
    """V1: an id used more than once in one file."""
    d = tasks.groupBy("project", "path", "task_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _v(d, "V1_duplicate_id", F.concat(F.col("path"), F.lit(" x"), F.col("n").cast("string")))


def missing_fields(tasks: DataFrame) -> DataFrame:
    """V2: required fields absent (one row per missing field)."""
    present = {"id": "has_id", "name": "has_name", "description": "has_description",
               "priority": "raw_priority", "status": "raw_status"}
    m = tasks.select("project", "task_id", F.explode(F.array_compact(F.array(*[
        F.when(~F.coalesce(F.col(c) if c.startswith("has_") else F.col(c).isNotNull(), F.lit(False)), F.lit(f))
        for f, c in present.items()]))).alias("field"))
    return _v(m, "V2_missing_field", F.col("field"))


def bad_enums(tasks: DataFrame) -> DataFrame:
    """V3: priority / status text outside the format's enums."""
    p = tasks.filter(F.col("raw_priority").isNotNull() & ~F.lower("raw_priority").isin(*PRIORITY_ENUM))
    s = tasks.filter(F.col("raw_status").isNotNull() & ~F.lower("raw_status").isin(*STATUS_ENUM))
    return (_v(p, "V3_priority", F.col("raw_priority"))
            .unionByName(_v(s, "V3_status", F.col("raw_status"))))


def dangling_dependencies(tasks: DataFrame) -> DataFrame:
    """V4: dependencies naming an id that is not in the same file."""
    e = tasks.select("path", "project", "task_id", F.explode("dependencies").alias("parent"))
    ids = tasks.select("path", F.col("task_id").alias("parent"))
    return _v(e.join(ids, ["path", "parent"], "left_anti"), "V4_unknown_dependency", F.col("parent"))


def phase_sizes(tasks: DataFrame, lo: int = 3, hi: int = 10) -> DataFrame:
    """V6: phases with fewer than ``lo`` or more than ``hi`` tasks."""
    p = (tasks.filter(F.col("shape") != "flat").groupBy("project", "path", "phase_pos", "label")
         .agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") < lo) | (F.col("n") > hi)))
    return p.select("project", F.lit("V6_phase_size").alias("rule"),
                    F.concat(F.col("path"), F.lit("#"), F.col("phase_pos").cast("string")).alias("task_id"),
                    F.concat(F.col("label"), F.lit(": "), F.col("n").cast("string"), F.lit(" tasks")).alias("detail"))


def non_kebab_ids(tasks: DataFrame) -> DataFrame:
    """V8: ids that are not kebab-case."""
    return _v(tasks.filter(~F.col("task_id").rlike(KEBAB)), "V8_not_kebab_case", F.col("task_id"))


def started_before_dependencies(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """In-progress or closed task with a dependency that is not closed."""
    t = tasks.select("project", "task_id", "status")
    bad = (deps.select("project", "child", "parent")
           .join(t.select("project", F.col("task_id").alias("child"), F.col("status").alias("child_status")),
                 ["project", "child"])
           .filter(F.col("child_status").isin("in_progress", "closed"))
           .join(t.select("project", F.col("task_id").alias("parent"), F.col("status").alias("parent_status")),
                 ["project", "parent"])
           .filter(F.col("parent_status") != "closed"))
    return bad.select("project", F.lit("V11_unfinished_dependency").alias("rule"), F.col("child").alias("task_id"),
                      F.concat(F.col("child_status"), F.lit(" waits for "), F.col("parent"), F.lit(" ("),
                               F.col("parent_status"), F.lit(")")).alias("detail"))


def validate_files(tasks: DataFrame) -> DataFrame:
    """V1–V4, V6, V8 over flattened task files."""
    return (duplicate_ids(tasks).unionByName(missing_fields(tasks)).unionByName(bad_enums(tasks))
            .unionByName(dangling_dependencies(tasks)).unionByName(phase_sizes(tasks))
            .unionByName(non_kebab_ids(tasks)))


def duplicate_agent_names(agents: DataFrame) -> DataFrame:
    """Agent names used twice in one scope (global, or one repository)."""
    return (agents.groupBy("scope", F.coalesce("repo", F.lit("")).alias("repo"), "name")
            .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))


def oversized_tasks(file_changes: DataFrame, limit: int = 750) -> DataFrame:
    """V9: tasks whose branch changes more than ``limit`` lines (the task id
    comes from the branch name)."""
    from keelson.functions.expr import extract_task_id
    c = (file_changes.withColumn("task_id", extract_task_id(F.col("branch")))
         .filter(F.col("task_id") != "")
         .groupBy("project", "task_id").agg(F.sum(F.col("insertions") + F.col("deletions")).cast("bigint").alias("lines")))
    return c.filter(F.col("lines") > limit)


def multi_claims(status_events: DataFrame) -> DataFrame:
    """An agent who claims a task while an earlier claim of theirs is
    still open. A claim runs from an in_progress event of a task to that
    task's next event (open-ended when there is none)."""
    wt = Window.partitionBy("project", "task_id").orderBy("ts", "event_id")
    ev = status_events.withColumn("next_ts", F.lead("ts").over(wt))
    claims = ev.filter(F.col("status") == "in_progress").select(
        "agent", "project", "task_id", "event_id", F.col("ts").alias("start_ts"), F.col("next_ts").alias("end_ts"))
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    # the latest end of the agent's earlier claims, over ranges: an agent's whole history is no single task
    c = running(claims, ["agent"], ["start_ts", "event_id"], prev_end=("max_before", F.coalesce("end_ts", far)))
    return (c.filter(F.col("prev_end") > F.col("start_ts"))
            .select("agent", "project", "task_id", "event_id", "start_ts", "end_ts"))


def new_task_status(file_tasks: DataFrame, tracker: DataFrame) -> DataFrame:
    """V7: a task that is in the files but not yet in the tracker is new; its
    status in the file must be 'pending'."""
    new = file_tasks.join(tracker.select("project", "task_id"), ["project", "task_id"], "left_anti")
    bad = new.filter(F.lower(F.coalesce("raw_status", F.lit("pending"))) != "pending")
    return _v(bad, "V7_new_task_not_pending", F.coalesce(F.col("raw_status"), F.lit("")))
