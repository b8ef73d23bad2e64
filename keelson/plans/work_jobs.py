"""Working-context (W*) and pull-request (P*) jobs over the fleet tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import context as W
from keelson.operators import pulls as P
from keelson.sources import pull_json as R
from keelson.sources.bind import Fleet

AS_OF = "2002-01-01 00:00:00"   # after the last commit of the tables


def _current(f: Fleet):
    """The checkouts, the tracker's list and its show texts all come from the tasks, which are read once."""
    f.read_once()
    return W.current_task(f.checkouts, f.task_list_lines, f.task_show_blocks)


def _base(f: Fleet):
    return W.base_branch(f.base_branches, f.tasks)


def current_task_job(spark, sf_dir):
    return _current(Fleet(spark, sf_dir))


def worktree_summary_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    current = _current(f)
    return W.worktree_summary(f.checkouts, f.porcelain_lines, f.stashes, current)


def branch_commits_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.branch_commits(f.commits, f.checkouts)


def recent_commit_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.recent_commit(f.commits, f.checkouts, AS_OF)


def commit_task_links_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.commit_task_links(f.commits, f.tasks)


def branch_diff_stats_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.branch_diff_stats(f.file_changes, _base(f))


def files_changed_job(spark, sf_dir):
    return W.files_changed(Fleet(spark, sf_dir).file_changes)


def hot_files_job(spark, sf_dir, k: int = 10):
    return W.hot_files(Fleet(spark, sf_dir).file_changes, k)


def changed_python_files_job(spark, sf_dir):
    return W.changed_files(Fleet(spark, sf_dir).file_changes, ".py", "M")


def log_digest_job(spark, sf_dir):
    return W.log_digest(Fleet(spark, sf_dir).log_blobs)


def test_command_job(spark, sf_dir):
    return W.detect_test_command(Fleet(spark, sf_dir).repo_files)


def open_pr_by_branch_job(spark, sf_dir):
    return P.existing_pr(Fleet(spark, sf_dir).pull_requests)


def branches_without_pr_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return P.branches_without_pr(f.branches, f.pull_requests, _base(f))


def check_counts_job(spark, sf_dir):
    return P.check_counts(Fleet(spark, sf_dir).pr_checks)


def check_details_job(spark, sf_dir):
    return P.check_details(Fleet(spark, sf_dir).pr_checks)


def check_failure_rate_job(spark, sf_dir):
    return P.check_failure_rate(Fleet(spark, sf_dir).pr_checks)


def review_summary_job(spark, sf_dir):
    return P.review_summary(Fleet(spark, sf_dir).pr_reviews)


def review_share_job(spark, sf_dir):
    return P.review_share(Fleet(spark, sf_dir).pr_reviews)


def comment_digest_job(spark, sf_dir):
    return P.comment_rows(Fleet(spark, sf_dir).pr_comments)


def decoded_prs_job(spark, sf_dir):
    return P.decode_prs(R.raw_prs(Fleet(spark, sf_dir).pull_requests))


def decoded_checks_job(spark, sf_dir):
    return P.decode_checks(R.raw_checks(Fleet(spark, sf_dir).pr_checks))


def decoded_reviews_job(spark, sf_dir):
    return P.decode_reviews(R.raw_reviews(Fleet(spark, sf_dir).pr_reviews))


def decoded_comments_job(spark, sf_dir):
    return P.decode_comments(R.raw_comments(Fleet(spark, sf_dir).pr_comments))


def pr_issues_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return P.pr_issues(f.pull_requests, f.pr_checks, f.pr_reviews, f.pr_comments)


def merge_ready_job(spark, sf_dir):
    return pr_issues_job(spark, sf_dir).filter("merge_ready").select("project", "number", "head_ref")


def large_prs_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return P.large_prs(f.pull_requests, f.file_changes)


def review_context_job(spark, sf_dir):
    return P.review_context(Fleet(spark, sf_dir).file_changes)


def context_next_job(spark, sf_dir):
    from keelson.operators import graph as g
    f = Fleet(spark, sf_dir)
    f.read_once(deps=True)
    nxt = g.next_tasks(g.ready_tasks(f.tasks, f.task_deps), 1)
    return W.context_next(W.current_task(f.checkouts, f.task_list_lines, f.task_show_blocks), W.status_counts(f.porcelain_lines), W.recent_commit(f.commits, f.checkouts, AS_OF),
                          g.triage(f.tasks, f.task_deps, 1), nxt)


def context_commits_job(spark, sf_dir):
    return W.context_commits(_branch_rows(Fleet(spark, sf_dir)))


def context_pr_files_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_pr_files(f.checkouts, W.files_changed(f.file_changes))


def context_prfix_checks_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_prfix_checks(f.checkouts, P.existing_pr(f.pull_requests), P.check_details(f.pr_checks))


def context_prfix_reviews_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_prfix_reviews(f.checkouts, P.existing_pr(f.pull_requests), f.pr_reviews)


def context_prfix_comments_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_prfix_comments(f.checkouts, P.existing_pr(f.pull_requests), P.comment_rows(f.pr_comments))


def diff_stat_job(spark, sf_dir):
    return W.diff_stat(Fleet(spark, sf_dir).worktree_hunks)


def context_feedback_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    current = _current(f)
    # only the diffs of checked-out branches are shown
    diff = W.branch_diff_stats(W.of_branches(f.file_changes, f.checkouts), _base(f)).drop("base_branch")
    return W.context_feedback(current, _base(f), diff, W.status_counts(f.porcelain_lines), _branch_rows(f))


def context_loop_job(spark, sf_dir):
    from keelson.operators import graph as g
    f = Fleet(spark, sf_dir)
    ready = g.ready_tasks(f.tasks, f.task_deps)
    return W.context_loop(f.checkouts, f.loop_modes, ready, g.next_tasks(ready, 1), W.detect_test_command(f.repo_files))


def autopilot_tasks_job(spark, sf_dir):
    from keelson.operators import graph as g
    f = Fleet(spark, sf_dir)
    return W.autopilot_tasks(f.loop_modes, g.ready_tasks(f.tasks, f.task_deps))


def error_digest_job(spark, sf_dir):
    return W.error_digest(Fleet(spark, sf_dir).log_blobs)


def _branch_rows(f: Fleet):
    return W.branch_commits(f.commits, f.checkouts)


def diff_sections_job(spark, sf_dir):
    return W.diff_sections(Fleet(spark, sf_dir).worktree_hunks)


def context_done_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_done(_current(f), _branch_rows(f), W.status_counts(f.porcelain_lines))


def context_resume_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    current = _current(f)
    wt = W.worktree_summary(f.checkouts, f.porcelain_lines, f.stashes, current)
    return W.context_resume(current, wt, _branch_rows(f))


def context_pr_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_pr(_current(f), _base(f), P.existing_pr(f.pull_requests), _branch_rows(f),
                        W.branch_diff_stats(f.file_changes, _base(f)), W.files_changed(f.file_changes),
                        W.status_counts(f.porcelain_lines))


def context_prfix_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    current = _current(f)
    issues = P.pr_issues(f.pull_requests, f.pr_checks, f.pr_reviews, f.pr_comments)
    return W.context_prfix(current, P.existing_pr(f.pull_requests), P.check_counts(f.pr_checks), issues,
                           P.review_summary(f.pr_reviews))


def context_stuck_job(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return W.context_stuck(_current(f), W.status_counts(f.porcelain_lines), W.diff_sections(f.worktree_hunks),
                           _branch_rows(f), W.error_digest(f.log_blobs))


JOBS = {
    "decoded_prs": decoded_prs_job,
    "decoded_checks": decoded_checks_job,
    "decoded_reviews": decoded_reviews_job,
    "decoded_comments": decoded_comments_job,
    "autopilot_tasks": autopilot_tasks_job,
    "error_digest": error_digest_job,
    "diff_sections": diff_sections_job,
    "context_done": context_done_job,
    "context_resume": context_resume_job,
    "context_pr": context_pr_job,
    "context_prfix": context_prfix_job,
    "context_stuck": context_stuck_job,
    "context_next": context_next_job,
    "context_commits": context_commits_job,
    "context_pr_files": context_pr_files_job,
    "context_prfix_checks": context_prfix_checks_job,
    "context_prfix_reviews": context_prfix_reviews_job,
    "context_prfix_comments": context_prfix_comments_job,
    "diff_stat": diff_stat_job,
    "context_feedback": context_feedback_job,
    "context_loop": context_loop_job,
    "current_task": current_task_job,
    "worktree_summary": worktree_summary_job,
    "branch_commits": branch_commits_job,
    "recent_commit": recent_commit_job,
    "commit_task_links": commit_task_links_job,
    "branch_diff_stats": branch_diff_stats_job,
    "files_changed": files_changed_job,
    "hot_files": hot_files_job,
    "changed_python_files": changed_python_files_job,
    "log_digest": log_digest_job,
    "test_command_by_repo": test_command_job,
    "open_pr_by_branch": open_pr_by_branch_job,
    "branches_without_pr": branches_without_pr_job,
    "check_counts": check_counts_job,
    "check_details": check_details_job,
    "check_failure_rate": check_failure_rate_job,
    "review_summary": review_summary_job,
    "review_share": review_share_job,
    "comment_digest": comment_digest_job,
    "pr_issues": pr_issues_job,
    "merge_ready": merge_ready_job,
    "large_prs": large_prs_job,
    "review_context": review_context_job,
}
