"""Task-graph jobs (G1–G18, V5) over the fleet tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import graph as g
from keelson.operators.scan import settled
from keelson.sources.bind import Fleet


def _fleet(spark, sf_dir):
    return Fleet(spark, sf_dir)


def _graph(spark, sf_dir):
    """The fleet with its tasks and their edges read once, for jobs that use them again and again."""
    return Fleet(spark, sf_dir).read_once(deps=True)


def _cyclic_deps(f: Fleet):
    return f.task_deps.unionByName(settled(f.back_edges))


def ready_tasks_job(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return g.ready_tasks(f.tasks, f.task_deps)


def next_tasks_job(spark, sf_dir, k: int = 1):
    f = _fleet(spark, sf_dir)
    return g.next_tasks(g.ready_tasks(f.tasks, f.task_deps), k)


def blocked_tasks_job(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return g.blocked_tasks(f.tasks, f.task_deps)


def newly_unblocked_job(spark, sf_dir):
    """What becomes ready when every in-progress task is closed."""
    f = _fleet(spark, sf_dir)
    closing = f.tasks.filter(F.col("status") == "in_progress")
    return g.newly_unblocked(f.tasks, f.task_deps, closing)


def status_counts_job(spark, sf_dir):
    return g.status_counts(_fleet(spark, sf_dir).tasks)


def progress_report_job(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return g.progress_report(f.tasks, f.task_deps)


def priority_distribution_job(spark, sf_dir):
    return g.priority_distribution(_fleet(spark, sf_dir).tasks)


def cycle_members_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.cycle_members(_cyclic_deps(f))


def graph_tree_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.graph_tree(f.tasks, f.task_deps)


def critical_path_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.critical_path(f.tasks, f.task_deps)


def parallel_tracks_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.parallel_tracks(f.tasks, f.task_deps)


def blockers_to_clear_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.blockers_to_clear(f.tasks, f.task_deps)


def pagerank_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.pagerank(f.tasks, f.task_deps).withColumn("rank", F.round("rank", 9))


def triage_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.triage(f.tasks, f.task_deps)


def quick_wins_job(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return g.quick_wins(f.tasks, f.task_deps)


def project_health_job(spark, sf_dir):
    f = _graph(spark, sf_dir)
    return g.project_health(f.tasks, f.task_deps, _cyclic_deps(f))


def priority_misalignment_job(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return g.priority_misalignment(f.tasks, f.task_deps)


def phase_order_violations_job(spark, sf_dir):
    """Phases of five tasks in sequence order; back edges cross them backwards."""
    f = _fleet(spark, sf_dir)
    t = f.tasks.withColumn("phase_pos", F.floor((F.col("seq") - 1) / 5).cast("bigint"))
    return g.phase_order_violations(t, _cyclic_deps(f))


JOBS = {
    "ready_tasks": ready_tasks_job,
    "next_tasks": next_tasks_job,
    "blocked_tasks": blocked_tasks_job,
    "newly_unblocked": newly_unblocked_job,
    "status_counts": status_counts_job,
    "progress_report": progress_report_job,
    "priority_distribution": priority_distribution_job,
    "cycle_members": cycle_members_job,
    "graph_tree": graph_tree_job,
    "critical_path": critical_path_job,
    "parallel_tracks": parallel_tracks_job,
    "blockers_to_clear": blockers_to_clear_job,
    "pagerank": pagerank_job,
    "triage": triage_job,
    "quick_wins": quick_wins_job,
    "project_health": project_health_job,
    "priority_misalignment": priority_misalignment_job,
    "phase_order_violations": phase_order_violations_job,
}
