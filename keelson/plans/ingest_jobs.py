"""Task-file ingestion (T1–T17) and validation (V1–V12) jobs.

The task files are rendered by Spark from the fleet's task table (20 tasks a
file, three layouts) and then run through the same decode/flatten path a
directory of real YAML files takes (``scan_task_docs`` reads those).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from keelson.operators import validate as V
from keelson.operators.graph import _cut
from keelson.session import checkpoint_dir
from keelson.sources import taskfiles as TF
from keelson.sources.bind import Fleet


def _files(f: Fleet):
    f.read_once(deps=True)
    updated = f.orders.select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("project"),
                              F.concat(F.lit("bd-"), F.col("o_orderkey").cast("string")).alias("task_id"),
                              F.col("o_orderdate").alias("updated_on"))
    return TF.render_task_docs(f.tasks, f.task_deps, updated)


def _decoded(f: Fleet):
    """Decoded documents, materialized once: every ingest job reads them
    several times and the YAML decode is the one Python step."""
    return _cut(TF.decode_task_docs(_files(f)))


def _normalized(f: Fleet):
    return _cut(TF.flatten_tasks(_decoded(f)))


def normalize_tasks_job(spark, sf_dir):
    return _normalized(Fleet(spark, sf_dir))


def _home(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def scanned_tasks_job(spark, sf_dir):
    """The task files written to shared storage, scanned, decoded, flattened."""
    home = _home(spark, "task-files")
    TF.write_task_bundles(_files(Fleet(spark, sf_dir)), home)
    return TF.flatten_tasks(_cut(TF.decode_task_docs(TF.scan_task_bundles(spark, home))))


def written_tasks_job(spark, sf_dir):
    """Flattened tasks written by the sink and read back."""
    home = _home(spark, "tasks")
    TF.write_tasks(TF.flatten_tasks(_decoded(Fleet(spark, sf_dir))), home)
    return TF.read_tasks(spark, home)


def validate_drafts_job(spark, sf_dir):
    """V1, V3, V8 on draft task lists, which hold repeated ids, texts outside the
    enums and ids that are not kebab-case."""
    t = Fleet(spark, sf_dir).draft_tasks
    return V.duplicate_ids(t).unionByName(V.bad_enums(t)).unionByName(V.non_kebab_ids(t))


def draft_reconcile_job(spark, sf_dir):
    """T13 on drafts: repeated ids, missing and extra tasks, status mismatches."""
    f = Fleet(spark, sf_dir)
    return TF.migration_reconcile(f.draft_tasks, f.tasks)


def file_dependency_edges_job(spark, sf_dir):
    return TF.dependency_edges(_normalized(Fleet(spark, sf_dir)))


def migration_actions_job(spark, sf_dir):
    t = _normalized(Fleet(spark, sf_dir))
    return TF.migration_actions(t, TF.dependency_edges(t))


def migration_reconcile_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return TF.migration_reconcile(_normalized(f), f.tasks)


def approx_task_count_job(spark, sf_dir):
    return TF.approx_task_count(_files(Fleet(spark, sf_dir)))


def external_dependencies_job(spark, sf_dir):
    return TF.external_dependencies(_decoded(Fleet(spark, sf_dir)))


def update_log_job(spark, sf_dir):
    return TF.update_log(_decoded(Fleet(spark, sf_dir)))


def agent_docs(f: Fleet):
    """Agent registry documents (nested JSON) derived from the event users."""
    e = f.events
    a = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("caps"),  # <= 5 event types
                                 F.min("ts").alias("first_ts"))
    uid = F.col("user_id")
    doc = F.to_json(F.struct(
        F.concat(F.lit("u"), (uid % 120).cast("string")).alias("name"),
        F.element_at(F.array(F.lit("review"), F.lit("implementation"), F.lit("testing")), (uid % 3 + 1).cast("int")).alias("type"),
        F.when(uid % 2 == 0, F.lit("global")).otherwise(F.lit("per-repo")).alias("scope"),
        F.when(uid % 2 == 1, F.concat(F.lit("p"), (uid % 10).cast("string"))).alias("repo"),
        F.element_at(F.array(F.lit("open"), F.lit("auto"), F.lit("contacts_only"), F.lit("block_all")),
                     (uid % 4 + 1).cast("int")).alias("contact_policy"),
        F.struct(F.col("caps").alias("capabilities"), F.array(F.lit("python")).alias("languages")).alias("profile"),
        F.struct(F.lit(3).alias("max_concurrent_reviews"), F.lit(24).alias("review_timeout_hours"), (uid % 2 == 0).alias("auto_claim_reviews"),
                 F.when(uid % 3 == 0, F.lit("structured-markdown")).alias("feedback_format"),
                 F.when(uid % 5 == 0, F.struct((uid % 24).alias("from"), F.lit("utc").alias("zone"))).alias("quiet_hours")).alias("behavior"),
        F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at")))
    return a.select(doc.alias("doc"))


def agent_registry_job(spark, sf_dir):
    return TF.agents_flat(agent_docs(Fleet(spark, sf_dir)))


def agent_capabilities_job(spark, sf_dir):
    return TF.agent_capabilities(agent_docs(Fleet(spark, sf_dir)))


def agent_behavior_job(spark, sf_dir):
    return TF.agent_behavior(agent_docs(Fleet(spark, sf_dir)))


def validate_tasks_job(spark, sf_dir):
    """V1–V4, V6, V8 on the task files, V11 on the tracker, V5 via cycles."""
    f = Fleet(spark, sf_dir)
    return V.validate_files(_normalized(f)).unionByName(V.started_before_dependencies(f.tasks, f.task_deps))


def duplicate_agent_names_job(spark, sf_dir):
    return V.duplicate_agent_names(TF.agents_flat(agent_docs(Fleet(spark, sf_dir))))


def oversized_tasks_job(spark, sf_dir):
    return V.oversized_tasks(Fleet(spark, sf_dir).file_changes)


def multi_claims_job(spark, sf_dir):
    return V.multi_claims(Fleet(spark, sf_dir).status_events)


def new_task_status_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return V.new_task_status(_normalized(f), f.tasks)


JOBS = {
    "scanned_tasks": scanned_tasks_job,
    "written_tasks": written_tasks_job,
    "validate_drafts": validate_drafts_job,
    "draft_reconcile": draft_reconcile_job,
    "new_task_status": new_task_status_job,
    "normalize_tasks": normalize_tasks_job,
    "dependency_edges": file_dependency_edges_job,
    "migration_actions": migration_actions_job,
    "migration_reconcile": migration_reconcile_job,
    "approx_task_count": approx_task_count_job,
    "external_dependencies": external_dependencies_job,
    "update_log": update_log_job,
    "agent_registry": agent_registry_job,
    "agent_capabilities": agent_capabilities_job,
    "agent_behavior": agent_behavior_job,
    "validate_tasks": validate_tasks_job,
    "duplicate_agent_names": duplicate_agent_names_job,
    "oversized_tasks": oversized_tasks_job,
    "multi_claims": multi_claims_job,
}
