"""Coordination jobs (M1–M20): threads, review documents, reservations, loops."""

from __future__ import annotations

from keelson.operators import coord as M
from keelson.sources.bind import Fleet

RESERVATION_AS_OF = "2024-01-10 00:00:00"
REVIEW_AS_OF = "2024-02-01 00:00:00"


def inbox_summary_job(spark, sf_dir):
    return M.inbox_summary(Fleet(spark, sf_dir).messages)


def thread_messages_job(spark, sf_dir):
    return M.thread_messages(Fleet(spark, sf_dir).messages)


def search_messages_job(spark, sf_dir):
    return M.search_messages(Fleet(spark, sf_dir).messages, "review", "*-review")


def escalations_job(spark, sf_dir):
    return M.escalations(Fleet(spark, sf_dir).messages)


def unclaimed_reviews_job(spark, sf_dir):
    return M.unclaimed_reviews(Fleet(spark, sf_dir).messages)


def overdue_reviews_job(spark, sf_dir):
    return M.overdue_reviews(Fleet(spark, sf_dir).messages, REVIEW_AS_OF)


def review_load_job(spark, sf_dir):
    return M.review_load(Fleet(spark, sf_dir).messages, cap=3)


def task_cycle_time_job(spark, sf_dir):
    return M.task_cycle_time(Fleet(spark, sf_dir).status_events)


def feedback_items_job(spark, sf_dir):
    return M.feedback_items(Fleet(spark, sf_dir).review_posts)


def verdicts_job(spark, sf_dir):
    posts = Fleet(spark, sf_dir).review_posts
    return M.verdicts(posts, M.feedback_items(posts))


def unresolved_feedback_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return M.unresolved_feedback(M.feedback_items(f.review_posts), M.resolutions(f.resolution_posts))


def active_reservations_job(spark, sf_dir):
    return M.active_reservations(Fleet(spark, sf_dir).reservations, RESERVATION_AS_OF)


def reservation_conflicts_job(spark, sf_dir):
    return M.reservation_conflicts(Fleet(spark, sf_dir).reservations)


def file_conflicts_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return M.file_conflicts(f.porcelain_lines, M.active_reservations(f.reservations, RESERVATION_AS_OF))


def loop_iterations_job(spark, sf_dir):
    return M.loop_iterations(Fleet(spark, sf_dir).loop_commits)


def loop_completion_job(spark, sf_dir):
    return M.loop_completion(Fleet(spark, sf_dir).loop_runs, max_iterations=30)


def delivery_check_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return M.delivery_check(f.messages, f.agent_policies, f.agent_contacts)


JOBS = {
    "delivery_check": delivery_check_job,
    "inbox_summary": inbox_summary_job,
    "thread_messages": thread_messages_job,
    "search_messages": search_messages_job,
    "escalations": escalations_job,
    "unclaimed_reviews": unclaimed_reviews_job,
    "overdue_reviews": overdue_reviews_job,
    "review_load": review_load_job,
    "task_cycle_time": task_cycle_time_job,
    "feedback_items": feedback_items_job,
    "verdicts": verdicts_job,
    "unresolved_feedback": unresolved_feedback_job,
    "active_reservations": active_reservations_job,
    "reservation_conflicts": reservation_conflicts_job,
    "file_conflicts": file_conflicts_job,
    "loop_iterations": loop_iterations_job,
    "loop_completion": loop_completion_job,
}
