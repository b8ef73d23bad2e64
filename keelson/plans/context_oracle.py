"""DuckDB oracle SQL for the context tables (W24/W25), composed from the
oracles of the operators they join."""

from __future__ import annotations

from keelson.plans.graph_oracle import ORACLES as G
from keelson.plans.graph_oracle import READY, T
from keelson.plans.work_oracle import BASE
from keelson.plans.work_oracle import ORACLES as WO
from keelson.sources.bind import oracle_with

STATUS_TEXT = """SELECT project, concat_ws(', ',
    CASE WHEN staged > 0 THEN CAST(staged AS VARCHAR) || ' staged' END,
    CASE WHEN modified > 0 THEN CAST(modified AS VARCHAR) || ' modified' END,
    CASE WHEN untracked > 0 THEN CAST(untracked AS VARCHAR) || ' untracked' END) AS status_text
  FROM (SELECT project,
          sum(CASE WHEN substr(xy, 1, 1) = '?' THEN 1 ELSE 0 END) AS untracked,
          sum(CASE WHEN substr(xy, 1, 1) NOT IN ('?', ' ') THEN 1 ELSE 0 END) AS staged,
          sum(CASE WHEN substr(xy, 2, 1) NOT IN (' ', '?') THEN 1 ELSE 0 END) AS modified
        FROM porcelain_lines WHERE length(xy) >= 2 GROUP BY project)"""

ORACLES: dict[str, str] = {}

ORACLES["context_next"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, coalesce(s.status_text, '') AS status_text, r.summary AS recent_commit,
       coalesce(t.task_id, n.task_id) AS recommended_task,
       CASE WHEN t.task_id IS NOT NULL THEN 'triage' WHEN n.task_id IS NOT NULL THEN 'ready' END AS recommended_by, t.score, t.reason
FROM ({WO["current_task"]}) c
LEFT JOIN ({oracle_with(["porcelain_lines"], STATUS_TEXT)}) s ON s.project = c.project
LEFT JOIN ({WO["recent_commit"]}) r ON r.project = c.project AND r.branch = c.branch
LEFT JOIN (SELECT * FROM ({G["triage"]}) WHERE rank_in_project = 1) t ON t.project = c.project
LEFT JOIN ({G["next_tasks"]}) n ON n.project = c.project"""

ORACLES["context_commits"] = f"""
SELECT project, branch, row_number() OVER (PARTITION BY project, branch ORDER BY ts DESC, sha DESC) AS pos, kind,
       substr(sha, 1, 7) || ' ' || string_split(subject, chr(10))[1] AS line
FROM ({WO["branch_commits"]})"""

_CHECKOUTS = oracle_with(["checkouts"], "SELECT project, branch FROM checkouts")

ORACLES["context_pr_files"] = f"""
SELECT f.project, f.branch, f.path, f.line FROM ({WO["files_changed"]}) f
JOIN ({_CHECKOUTS}) k ON k.project = f.project AND k.branch = f.branch"""

_MINE = f"""SELECT k.project, k.branch, p.number FROM ({_CHECKOUTS}) k
  JOIN ({WO["open_pr_by_branch"]}) p ON p.project = k.project AND p.head_ref = k.branch"""

ORACLES["context_prfix_checks"] = f"""
SELECT m.project, m.branch, m.number, d.category, d.seq, d.name, d.line FROM ({_MINE}) m
JOIN ({WO["check_details"]}) d ON d.project = m.project AND d.number = m.number"""

ORACLES["context_prfix_reviews"] = f"""
SELECT m.project, m.branch, m.number, r.seq, r.author, r.state,
       '- ' || CASE r.state WHEN 'APPROVED' THEN '✅' WHEN 'CHANGES_REQUESTED' THEN '❌' WHEN 'COMMENTED' THEN '💬'
                            WHEN 'PENDING' THEN '⏳' WHEN 'DISMISSED' THEN '🚫' ELSE '•' END || ' **' || r.author || '**: ' || r.state AS line
FROM ({_MINE}) m JOIN ({oracle_with(["pr_reviews"], "SELECT * FROM pr_reviews")}) r ON r.project = m.project AND r.number = m.number"""

ORACLES["context_prfix_comments"] = f"""
SELECT m.project, m.branch, m.number, c.author, c.location, c.quoted,
       '**@' || c.author || '** on `' || c.location || '`:' || chr(10) || c.quoted AS text
FROM ({_MINE}) m JOIN ({WO["comment_digest"]}) c ON c.project = m.project AND c.number = m.number"""

COMMITS_ON_BRANCH = f"SELECT project, branch, count(*) AS n FROM ({WO['branch_commits']}) GROUP BY project, branch"
STATUS = oracle_with(["porcelain_lines"], STATUS_TEXT)

ORACLES["context_feedback"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, coalesce(nullif(c.task_id, ''), '<task-id>') || '-review' AS review_thread,
       b.base_branch, coalesce(s.status_text, '') AS status_text, d.files, d.insertions, d.deletions, d.summary,
       coalesce(bc.n, 0) AS commits_on_branch
FROM ({WO["current_task"]}) c
LEFT JOIN ({oracle_with(["tasks", "base_branches"], BASE)}) b ON b.project = c.project
LEFT JOIN ({STATUS}) s ON s.project = c.project
LEFT JOIN ({COMMITS_ON_BRANCH}) bc ON bc.project = c.project AND bc.branch = c.branch
LEFT JOIN ({WO["branch_diff_stats"]}) d ON d.project = c.project AND d.branch = c.branch"""

_SAFE = "replace(replace(replace(replace({0}.title, '(', '['), ')', ']'), '`', chr(39)), '$', '')"
_MODES = oracle_with(["loop_modes"], "SELECT * FROM loop_modes")

ORACLES["context_loop"] = f"""
SELECT k.project, k.branch, m.mode, CASE WHEN m.mode = 'goal' THEN m.goal END AS goal,
       CASE WHEN m.mode = 'single' THEN n.task_id END AS task_id,
       CASE WHEN m.mode = 'single' THEN {_SAFE.format('n')} END AS safe_title,
       CAST(coalesce(rc.k, 0) AS BIGINT) AS ready_tasks,
       coalesce(tc.test_command, '# No test runner detected - verify manually or add tests') AS test_command,
       '<promise>COMPLETE</promise>' AS completion_promise
FROM ({oracle_with(["checkouts"], "SELECT project, branch FROM checkouts")}) k
JOIN (SELECT p.project, l.goal, CASE WHEN coalesce(l.goal, '') <> '' THEN 'goal' WHEN coalesce(l.autopilot, false) THEN 'autopilot'
             ELSE 'single' END AS mode
      FROM ({oracle_with(["checkouts"], "SELECT project FROM checkouts")}) p LEFT JOIN ({_MODES}) l ON l.project = p.project) m
  ON m.project = k.project
LEFT JOIN ({G["next_tasks"]}) n ON n.project = k.project
LEFT JOIN ({oracle_with(T, "SELECT project, count(*) AS k FROM (" + READY + ") GROUP BY project")}) rc
  ON rc.project = k.project
LEFT JOIN ({WO["test_command_by_repo"]}) tc ON tc.project = k.project"""

ORACLES["autopilot_tasks"] = f"""
SELECT r.project, row_number() OVER (PARTITION BY r.project ORDER BY priority, seq, task_id) AS pos, task_id,
       {_SAFE.format('r')} AS safe_title, priority
FROM ({oracle_with(T, READY)}) r
WHERE r.project IN (SELECT project FROM ({_MODES}) WHERE goal IS NULL AND autopilot)"""


_STAT = """
SELECT project, side, path, insertions, deletions,
       ' ' || path || ' | ' || CAST(insertions + deletions AS VARCHAR) || ' ' ||
         repeat('+', CASE WHEN insertions + deletions <= 60 THEN insertions ELSE CAST(floor(insertions * 60 / (insertions + deletions)) AS BIGINT) END) ||
         repeat('-', CASE WHEN insertions + deletions <= 60 THEN deletions ELSE CAST(floor(deletions * 60 / (insertions + deletions)) AS BIGINT) END) AS line
FROM (SELECT project, side, path, CAST(sum(insertions) AS BIGINT) AS insertions, CAST(sum(deletions) AS BIGINT) AS deletions
      FROM (SELECT *, 'staged' AS side FROM worktree_hunks WHERE staged UNION ALL SELECT *, 'unstaged' AS side FROM worktree_hunks WHERE unstaged)
      GROUP BY project, side, path)"""

ORACLES["diff_stat"] = oracle_with(["worktree_hunks"], _STAT)


def _side(side):
    """One --stat part: its files, and its text with title and summary."""
    return f"""SELECT project, count(*) AS n, '{side.title()}:' || chr(10) || string_agg(line, chr(10) ORDER BY path) || chr(10) || ' ' ||
        concat_ws(', ', count(*) || CASE WHEN count(*) = 1 THEN ' file changed' ELSE ' files changed' END,
          CASE WHEN sum(insertions) > 0 THEN sum(insertions) || CASE WHEN sum(insertions) = 1 THEN ' insertion(+)' ELSE ' insertions(+)' END END,
          CASE WHEN sum(deletions) > 0 THEN sum(deletions) || CASE WHEN sum(deletions) = 1 THEN ' deletion(-)' ELSE ' deletions(-)' END END) AS l
      FROM st WHERE side = '{side}' GROUP BY project"""


DIFF = oracle_with(["worktree_hunks"], f"""
SELECT project, n_staged, n_unstaged, CAST(len(parts) AS BIGINT) AS n_lines,
       CASE WHEN len(parts) <= 100 THEN joined
            ELSE array_to_string(parts[1:100], chr(10)) || chr(10) || '... (' || CAST(len(parts) - 100 AS VARCHAR) || ' more lines)' END AS diff
FROM (SELECT *, string_split(joined, chr(10)) AS parts FROM (
  SELECT p.project, coalesce(sa.n, 0) AS n_staged, coalesce(ua.n, 0) AS n_unstaged,
         concat_ws(chr(10) || chr(10), sa.l, ua.l, ca.l) AS joined
  FROM (SELECT DISTINCT project FROM worktree_hunks) p
  LEFT JOIN ({_side("staged")}) sa ON sa.project = p.project
  LEFT JOIN ({_side("unstaged")}) ua ON ua.project = p.project
  LEFT JOIN (SELECT project, string_agg(l, chr(10) ORDER BY path) AS l FROM (
      SELECT project, path, 'diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path || chr(10)
               || string_agg(hunk, chr(10) ORDER BY hunk_no) AS l
      FROM worktree_hunks GROUP BY project, path) GROUP BY project) ca ON ca.project = p.project))""",
    ctes=[("st", _STAT)])

ORACLES["diff_sections"] = DIFF


ORACLES["context_done"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, c.status, coalesce(bc.n, 0) AS commits_on_branch,
       coalesce(s.status_text, '') AS status_text
FROM ({WO["current_task"]}) c
LEFT JOIN ({COMMITS_ON_BRANCH}) bc ON bc.project = c.project AND bc.branch = c.branch
LEFT JOIN ({STATUS}) s ON s.project = c.project"""

ORACLES["context_resume"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, c.status, w.status_text, w.pending_items,
       coalesce(bc.n, 0) AS commits_on_branch
FROM ({WO["current_task"]}) c
LEFT JOIN ({WO["worktree_summary"]}) w ON w.project = c.project AND w.branch = c.branch
LEFT JOIN ({COMMITS_ON_BRANCH}) bc ON bc.project = c.project AND bc.branch = c.branch"""

ORACLES["context_pr"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, b.base_branch, p.number AS pr_number, p.title AS pr_title, p.state AS pr_state, p.url AS pr_url,
       coalesce(bc.n, 0) AS commits_on_branch, d.summary AS diff_summary, coalesce(fc.n, 0) AS files_changed,
       coalesce(s.status_text, '') AS status_text
FROM ({WO["current_task"]}) c
LEFT JOIN ({oracle_with(["tasks", "base_branches"], BASE)}) b ON b.project = c.project
LEFT JOIN ({WO["open_pr_by_branch"]}) p ON p.project = c.project AND p.head_ref = c.branch
LEFT JOIN ({COMMITS_ON_BRANCH}) bc ON bc.project = c.project AND bc.branch = c.branch
LEFT JOIN ({WO["branch_diff_stats"]}) d ON d.project = c.project AND d.branch = c.branch
LEFT JOIN (SELECT project, branch, count(*) AS n FROM ({WO["files_changed"]}) GROUP BY project, branch) fc
  ON fc.project = c.project AND fc.branch = c.branch
LEFT JOIN ({STATUS}) s ON s.project = c.project"""

ORACLES["context_prfix"] = f"""
SELECT k.project, k.branch, k.task_id, k.title, p.number, p.title AS pr_title, p.url AS pr_url, p.state AS pr_state, p.base_ref,
       coalesce(cc.passing, 0) AS passing, coalesce(cc.failing, 0) AS failing,
       coalesce(cc.pending, 0) AS pending, coalesce(rs.reviews, 0) AS reviews, i.mergeable_label, i.issues,
       i.merge_ready, p.number IS NOT NULL AS has_pr
FROM ({WO["current_task"]}) k
LEFT JOIN ({WO["open_pr_by_branch"]}) p ON p.project = k.project AND p.head_ref = k.branch
LEFT JOIN ({WO["check_counts"]}) cc ON cc.project = p.project AND cc.number = p.number
LEFT JOIN ({WO["review_summary"]}) rs ON rs.project = p.project AND rs.number = p.number
LEFT JOIN ({WO["pr_issues"]}) i ON i.project = p.project AND i.number = p.number"""

ORACLES["context_stuck"] = f"""
SELECT c.project, c.branch, c.task_id, c.title, coalesce(s.status_text, '') AS status_text,
       coalesce(d.diff, '') AS diff, coalesce(bc.n, 0) AS commits_on_branch,
       coalesce(e.failed_runs, 0) AS failed_runs, coalesce(e.errors, '') AS errors
FROM ({WO["current_task"]}) c
LEFT JOIN ({STATUS}) s ON s.project = c.project
LEFT JOIN ({DIFF}) d ON d.project = c.project
LEFT JOIN ({COMMITS_ON_BRANCH}) bc ON bc.project = c.project AND bc.branch = c.branch
LEFT JOIN ({WO["error_digest"]}) e ON e.project = c.project"""
