"""DuckDB oracle SQL for the working-context and pull-request jobs."""

from __future__ import annotations

from keelson.sources.bind import oracle_with

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"

ORACLES: dict[str, str] = {}

CURRENT = """
SELECT c.project, c.branch,
  coalesce(f.lid, c.bid) AS task_id,
  coalesce(f.ltitle, s.stitle, '') AS title,
  CASE WHEN f.lid IS NOT NULL THEN 'in_progress' ELSE coalesce(s.sstatus, '') END AS status,
  CASE WHEN f.lid IS NOT NULL THEN 'in_progress_list' WHEN c.bid <> '' THEN 'branch' ELSE 'none' END AS source
FROM (SELECT project, branch,
        coalesce(nullif(regexp_extract(branch, '(bd-\\d+)', 1), ''), nullif(regexp_extract(branch, '(BEAD-\\d+)', 1), ''),
                 nullif(regexp_extract(branch, '(bead-\\d+)', 1), ''), '') AS bid
      FROM checkouts) c
LEFT JOIN (
  SELECT project, lid, ltitle FROM (
    SELECT project, seq, regexp_extract(trim(line), '^(bd-\\d+)\\s+(.+?)(?:\\s+\\[.+\\])?$', 1) AS lid,
           trim(regexp_extract(trim(line), '^(bd-\\d+)\\s+(.+?)(?:\\s+\\[.+\\])?$', 2)) AS ltitle,
           row_number() OVER (PARTITION BY project ORDER BY seq) AS rn
    FROM task_list_lines WHERE status = 'in_progress'
      AND regexp_extract(trim(line), '^(bd-\\d+)', 1) <> '') WHERE rn = 1) f ON f.project = c.project
LEFT JOIN (
  SELECT project, task_id,
         trim(regexp_extract(block, '(?m)^Title:([^\\n]*)', 1)) AS stitle,
         trim(regexp_extract(block, '(?m)^Status:([^\\n]*)', 1)) AS sstatus
  FROM task_show_blocks) s ON s.project = c.project AND s.task_id = c.bid
"""

ORACLES["current_task"] = oracle_with(["checkouts", "task_list_lines", "task_show_blocks"], CURRENT)

ORACLES["worktree_summary"] = oracle_with(
    ["checkouts", "task_list_lines", "task_show_blocks", "porcelain_lines", "stashes"], """
SELECT project, branch, staged, modified, untracked, status_text, stash_count, ahead, behind,
  list_filter([
    CASE WHEN stash_count > 0 THEN '⚠️ ' || CAST(stash_count AS VARCHAR) || ' stashed change(s) - consider applying or dropping' END,
    CASE WHEN behind > 0 THEN '⚠️ Branch is ' || info || ' - consider pulling'
         WHEN ahead > 0 THEN '📤 Branch is ' || info || ' - remember to push' END,
    CASE WHEN coalesce(task_id, '') <> '' THEN '💬 Check inbox for messages in ' || task_id || '-review thread' END
  ], lambda x: x IS NOT NULL) AS pending_items
FROM (
  SELECT k.project, k.branch, k.info,
    coalesce(TRY_CAST(nullif(regexp_extract(k.info, 'ahead (\\d+)', 1), '') AS BIGINT), 0) AS ahead,
    coalesce(TRY_CAST(nullif(regexp_extract(k.info, 'behind (\\d+)', 1), '') AS BIGINT), 0) AS behind,
    coalesce(p.staged, 0) AS staged, coalesce(p.modified, 0) AS modified, coalesce(p.untracked, 0) AS untracked,
    coalesce(p.status_text, '') AS status_text, coalesce(s.n, 0) AS stash_count, ct.task_id
  FROM (SELECT project, branch, regexp_extract(header, '\\[([^\\]]+)\\]', 1) AS info FROM checkouts) k
  LEFT JOIN (
    SELECT *, concat_ws(', ',
        CASE WHEN staged > 0 THEN CAST(staged AS VARCHAR) || ' staged' END,
        CASE WHEN modified > 0 THEN CAST(modified AS VARCHAR) || ' modified' END,
        CASE WHEN untracked > 0 THEN CAST(untracked AS VARCHAR) || ' untracked' END) AS status_text
    FROM (SELECT project,
            CAST(sum(CASE WHEN substr(xy, 1, 1) = '?' THEN 1 ELSE 0 END) AS BIGINT) AS untracked,
            CAST(sum(CASE WHEN substr(xy, 1, 1) NOT IN ('?', ' ') THEN 1 ELSE 0 END) AS BIGINT) AS staged,
            CAST(sum(CASE WHEN substr(xy, 2, 1) NOT IN (' ', '?') THEN 1 ELSE 0 END) AS BIGINT) AS modified
          FROM porcelain_lines WHERE length(xy) >= 2 GROUP BY project)) p ON p.project = k.project
  LEFT JOIN (SELECT project, count(*) AS n FROM stashes GROUP BY project) s ON s.project = k.project
  LEFT JOIN cur ct ON ct.project = k.project AND ct.branch = k.branch)""",
    ctes=[("cur", CURRENT)])

ORACLES["branch_commits"] = oracle_with(["commits", "checkouts"], """
SELECT project, branch, sha, subject, ts, 'ahead_of_base' AS kind FROM ahead
UNION ALL
SELECT project, branch, sha, subject, ts, 'recent' FROM (
  SELECT c.*, row_number() OVER (PARTITION BY project, branch ORDER BY ts DESC, sha DESC) AS r FROM cc c
  WHERE NOT EXISTS (SELECT 1 FROM ahead a WHERE a.project = c.project AND a.branch = c.branch)) WHERE r <= 5""",
    ctes=[("cc", "SELECT m.* FROM commits m WHERE EXISTS (SELECT 1 FROM checkouts k WHERE k.project = m.project AND k.branch = m.branch)"),
          ("ahead", """SELECT c.* FROM cc c WHERE NOT EXISTS (
                         SELECT 1 FROM commits b WHERE b.on_base AND b.project = c.project AND b.sha = c.sha)""")])

_AGE = f"""
CASE WHEN s < 0 THEN 'in the future'
     WHEN s < 90 THEN CAST(s AS VARCHAR) || ' second' || CASE WHEN s = 1 THEN '' ELSE 's' END || ' ago'
     WHEN m < 90 THEN CAST(m AS VARCHAR) || ' minute' || CASE WHEN m = 1 THEN '' ELSE 's' END || ' ago'
     WHEN h < 36 THEN CAST(h AS VARCHAR) || ' hour' || CASE WHEN h = 1 THEN '' ELSE 's' END || ' ago'
     WHEN d < 14 THEN CAST(d AS VARCHAR) || ' day' || CASE WHEN d = 1 THEN '' ELSE 's' END || ' ago'
     WHEN d < 70 THEN CAST((d + 3) // 7 AS VARCHAR) || ' week' || CASE WHEN (d + 3) // 7 = 1 THEN '' ELSE 's' END || ' ago'
     WHEN d < 365 THEN CAST((d + 15) // 30 AS VARCHAR) || ' month' || CASE WHEN (d + 15) // 30 = 1 THEN '' ELSE 's' END || ' ago'
     WHEN d < 1825 AND tm % 12 <> 0 THEN CAST(tm // 12 AS VARCHAR) || ' year' || CASE WHEN tm // 12 = 1 THEN '' ELSE 's' END
          || ', ' || CAST(tm % 12 AS VARCHAR) || ' month' || CASE WHEN tm % 12 = 1 THEN '' ELSE 's' END || ' ago'
     WHEN d < 1825 THEN CAST(tm // 12 AS VARCHAR) || ' year' || CASE WHEN tm // 12 = 1 THEN '' ELSE 's' END || ' ago'
     ELSE CAST((d + 183) // 365 AS VARCHAR) || ' year' || CASE WHEN (d + 183) // 365 = 1 THEN '' ELSE 's' END || ' ago' END"""

ORACLES["recent_commit"] = oracle_with(["commits", "checkouts"], f"""
SELECT project, branch, sha, subject, ts, {_AGE} AS age, subject || ' (' || {_AGE} || ')' AS summary
FROM (SELECT *, (d * 24 + 365) // 730 AS tm FROM (
  SELECT *, (h + 12) // 24 AS d FROM (
    SELECT *, (m + 30) // 60 AS h FROM (
      SELECT *, (s + 30) // 60 AS m FROM (
        SELECT project, branch, sha, subject, ts,
               CAST(floor(epoch({AS_OF})) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS s
        FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY ts DESC, sha DESC) AS r
              FROM commits WHERE (project, branch) IN (SELECT (project, branch) FROM checkouts))
        WHERE r = 1)))))""")

ORACLES["commit_task_links"] = oracle_with(["commits", "tasks"], """
SELECT c.project, c.task_id, c.branch, c.sha, c.subject, t.status, t.title AS task_title,
       t.status IS NOT NULL AS task_found
FROM (SELECT project, branch, sha, subject,
        coalesce(nullif(regexp_extract(subject, '^(bd-\\d+):', 1), ''),
                 nullif(regexp_extract(subject, '^\\[([A-Za-z0-9._-]+)\\]', 1), ''),
                 nullif(regexp_extract(subject, '(?m)^Bead: (bd-\\d+)\\s*$', 1), '')) AS task_id
      FROM commits) c
LEFT JOIN tasks t ON t.project = c.project AND t.task_id = c.task_id
WHERE c.task_id IS NOT NULL""")

BASE = """SELECT p.project, CASE WHEN f.has_main THEN 'main' WHEN f.has_master THEN 'master' ELSE 'main' END AS base_branch
FROM (SELECT DISTINCT project FROM tasks) p
LEFT JOIN (SELECT project, bool_or(name = 'main') AS has_main, bool_or(name = 'master') AS has_master
           FROM base_branches GROUP BY project) f ON f.project = p.project"""

ORACLES["branch_diff_stats"] = oracle_with(["file_changes", "tasks", "base_branches"], """
SELECT s.*, b.base_branch,
  CAST(files AS VARCHAR) || CASE WHEN files = 1 THEN ' file changed' ELSE ' files changed' END || ', ' ||
  CAST(insertions AS VARCHAR) || ' insertions(+), ' || CAST(deletions AS VARCHAR) || ' deletions(-)' AS summary
FROM (SELECT project, branch, count(DISTINCT path) AS files, CAST(sum(insertions) AS BIGINT) AS insertions,
             CAST(sum(deletions) AS BIGINT) AS deletions, count(DISTINCT sha) AS commits
      FROM file_changes WHERE NOT on_base GROUP BY project, branch) s
LEFT JOIN base b ON b.project = s.project""", ctes=[("base", BASE)])

ORACLES["files_changed"] = oracle_with(["file_changes"], """
SELECT project, branch, path, change_type, change_type || chr(9) || path AS line FROM (
  SELECT *, row_number() OVER (PARTITION BY project, branch, path ORDER BY ts DESC, sha DESC, change_type DESC) AS r
  FROM file_changes WHERE NOT on_base) WHERE r = 1""")

ORACLES["hot_files"] = oracle_with(["file_changes"], """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY project ORDER BY branches DESC, churn DESC, path) AS rank FROM (
    SELECT project, path, count(DISTINCT branch) AS branches, CAST(sum(insertions + deletions) AS BIGINT) AS churn
    FROM file_changes GROUP BY project, path)) WHERE rank <= 10""")

ORACLES["changed_python_files"] = oracle_with(["file_changes"], """
SELECT DISTINCT project, branch, path FROM file_changes WHERE change_type = 'M' AND path LIKE '%.py'""")

_HEAD = """CASE tool WHEN 'go build' THEN 'Go build errors:' WHEN 'go vet' THEN 'Go vet issues:'
  WHEN 'tsc' THEN 'TypeScript errors:' WHEN 'py_compile' THEN 'Python syntax error' ELSE tool || ':' END"""

ORACLES["log_digest"] = oracle_with(["log_blobs"], f"""
SELECT log_id, project, tool, heading, n_lines,
  heading || chr(10) || CASE WHEN len(parts) <= 50 THEN output
     ELSE array_to_string(list_slice(parts, 1, 50), chr(10)) || chr(10) || '... (' || CAST(len(parts) - 50 AS VARCHAR) || ' more lines)' END AS excerpt
FROM (SELECT log_id, project, tool, output, {_HEAD} AS heading, string_split(output, chr(10)) AS parts,
        CAST(CASE WHEN output = '' THEN 0
             ELSE len(string_split(regexp_replace(output, '^\\s+|\\s+$', '', 'g'), chr(10))) END AS BIGINT) AS n_lines
      FROM log_blobs WHERE exit_code <> 0 AND output <> '')""")

ORACLES["error_digest"] = oracle_with(["log_blobs"], f"""
SELECT project, failed_runs, CAST(len(parts) AS BIGINT) AS n_lines,
  CASE WHEN len(parts) <= 50 THEN joined
       ELSE array_to_string(parts[1:50], chr(10)) || chr(10) || '... (' || CAST(len(parts) - 50 AS VARCHAR) || ' more lines)' END AS errors
FROM (SELECT *, string_split(joined, chr(10)) AS parts FROM (
  SELECT project, count(*) AS failed_runs,
         string_agg({_HEAD} || chr(10) || output, chr(10) || chr(10)
                    ORDER BY CASE tool WHEN 'go build' THEN 1 WHEN 'go vet' THEN 2 WHEN 'tsc' THEN 3 ELSE 4 END, log_id) AS joined
  FROM log_blobs WHERE exit_code <> 0 AND output <> '' GROUP BY project))""")

ORACLES["test_command_by_repo"] = oracle_with(["repo_files"], """
SELECT project, CASE WHEN go THEN 'go test ./... && go build ./...'
  WHEN pkg THEN CASE WHEN yarn THEN 'yarn test' WHEN pnpm THEN 'pnpm test' ELSE 'npm test' END
  WHEN pyp THEN 'pytest' WHEN setup THEN 'pytest' WHEN cargo THEN 'cargo test && cargo build'
  WHEN make THEN 'make test' ELSE '# No test runner detected - verify manually or add tests' END AS test_command
FROM (SELECT project, bool_or(path = 'go.mod') AS go, bool_or(path = 'package.json') AS pkg,
        bool_or(path = 'yarn.lock') AS yarn, bool_or(path = 'pnpm-lock.yaml') AS pnpm,
        bool_or(path = 'pyproject.toml') AS pyp, bool_or(path = 'setup.py') AS setup,
        bool_or(path = 'Cargo.toml') AS cargo, bool_or(path = 'Makefile') AS make
      FROM repo_files WHERE path NOT LIKE '%/%' GROUP BY project)""")

ORACLES["open_pr_by_branch"] = oracle_with(["pull_requests"], """
SELECT project, number, title, head_ref, base_ref, state, mergeable, url FROM (
  SELECT *, row_number() OVER (PARTITION BY project, head_ref ORDER BY number DESC) AS r
  FROM pull_requests WHERE state = 'OPEN') WHERE r = 1""")

ORACLES["branches_without_pr"] = oracle_with(["branches", "pull_requests", "tasks", "base_branches"], """
SELECT b.project, b.branch, bb.base_branch FROM branches b LEFT JOIN base bb ON bb.project = b.project
WHERE b.branch NOT IN ('main', 'master') AND b.branch <> coalesce(bb.base_branch, 'main')
  AND NOT EXISTS (SELECT 1 FROM pull_requests p WHERE p.state = 'OPEN' AND p.project = b.project AND p.head_ref = b.branch)""",
    ctes=[("base", BASE)])

_CAT = """CASE WHEN coalesce(status, '') <> 'COMPLETED' THEN 'pending'
  WHEN conclusion IN ('SUCCESS', 'SKIPPED', 'NEUTRAL') THEN 'passing' ELSE 'failing' END"""

ORACLES["decoded_prs"] = oracle_with(["pull_requests"], """
SELECT project, number, title, 'https://git.example/' || project || '/' || CAST(number AS VARCHAR) AS url, state, mergeable,
       base_ref AS baseRefName, head_ref AS headRefName FROM pull_requests""")

ORACLES["decoded_checks"] = oracle_with(["pr_checks"], """
SELECT project, number, seq, name, status, conclusion, details_url FROM pr_checks""")

ORACLES["decoded_reviews"] = oracle_with(["pr_reviews"], """
SELECT project, number, row_number() OVER (PARTITION BY project, number ORDER BY seq) AS seq, author, state,
       CASE state WHEN 'APPROVED' THEN '✅' WHEN 'CHANGES_REQUESTED' THEN '❌' WHEN 'COMMENTED' THEN '💬'
                  WHEN 'PENDING' THEN '⏳' WHEN 'DISMISSED' THEN '🚫' ELSE '•' END AS mark,
       'review ' || CAST(seq AS VARCHAR) AS body FROM pr_reviews""")

ORACLES["decoded_comments"] = oracle_with(["pr_comments"], """
SELECT project, number, row_number() OVER (PARTITION BY project, number ORDER BY line) AS seq,
  coalesce(author_login, user_login, '') AS author, path, CAST(line AS BIGINT) AS line,
  CASE WHEN coalesce(line, 0) > 0 THEN path || ':' || CAST(line AS VARCHAR) ELSE path END AS location,
  array_to_string(list_transform(string_split(body, chr(10)), lambda l: '> ' || l), chr(10)) AS quoted
FROM pr_comments""")

ORACLES["check_counts"] = oracle_with(["pr_checks"], f"""
SELECT project, number,
  CAST(sum(CASE WHEN cat = 'passing' THEN 1 ELSE 0 END) AS BIGINT) AS passing,
  CAST(sum(CASE WHEN cat = 'failing' THEN 1 ELSE 0 END) AS BIGINT) AS failing,
  CAST(sum(CASE WHEN cat = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
  count(*) AS total
FROM (SELECT project, number, {_CAT} AS cat FROM pr_checks) GROUP BY project, number""")

ORACLES["check_details"] = oracle_with(["pr_checks"], f"""
SELECT project, number, category, seq, name,
  CASE WHEN category = 'failing' THEN '❌ ' || name ||
       CASE WHEN coalesce(details_url, '') <> '' THEN chr(10) || '   ' || details_url ELSE '' END
       ELSE '⏳ ' || name END AS line
FROM (SELECT *, {_CAT} AS category FROM pr_checks) WHERE category <> 'passing'""")

ORACLES["check_failure_rate"] = oracle_with(["pr_checks"], f"""
SELECT *, rank() OVER (ORDER BY failure_rate DESC, name) AS rank FROM (
  SELECT name, count(*) AS runs, CAST(sum(CASE WHEN cat = 'failing' THEN 1 ELSE 0 END) AS BIGINT) AS failures,
         round(sum(CASE WHEN cat = 'failing' THEN 1 ELSE 0 END) / count(*), 6) AS failure_rate
  FROM (SELECT name, {_CAT} AS cat FROM pr_checks) WHERE cat <> 'pending' GROUP BY name)""")

ORACLES["review_summary"] = oracle_with(["pr_reviews"], """
SELECT project, number, count(*) AS reviews,
  CAST(sum(CASE WHEN upper(state) = 'APPROVED' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
  CAST(sum(CASE WHEN upper(state) = 'CHANGES_REQUESTED' THEN 1 ELSE 0 END) AS BIGINT) AS changes_requested,
  CAST(sum(CASE WHEN upper(state) = 'COMMENTED' THEN 1 ELSE 0 END) AS BIGINT) AS commented,
  arg_min(author, seq) FILTER (WHERE upper(state) = 'CHANGES_REQUESTED') AS first_change_requester
FROM pr_reviews GROUP BY project, number""")

ORACLES["review_share"] = oracle_with(["pr_reviews"], """
SELECT *, round(approvals / reviews, 6) AS approval_share, rank() OVER (ORDER BY reviews DESC, author) AS rank FROM (
  SELECT author, count(*) AS reviews, CAST(sum(CASE WHEN upper(state) = 'APPROVED' THEN 1 ELSE 0 END) AS BIGINT) AS approvals
  FROM pr_reviews GROUP BY author)""")

ORACLES["comment_digest"] = oracle_with(["pr_comments"], """
SELECT project, number, coalesce(author_login, user_login, '') AS author, path, line,
  CASE WHEN coalesce(line, 0) > 0 THEN path || ':' || CAST(line AS VARCHAR) ELSE path END AS location,
  array_to_string(list_transform(string_split(body, chr(10)), lambda l: '> ' || l), chr(10)) AS quoted
FROM pr_comments""")

ISSUES = f"""
SELECT project, number, head_ref,
  CASE upper(mergeable) WHEN 'MERGEABLE' THEN '✅ Yes' WHEN 'CONFLICTING' THEN '❌ Conflicts'
       WHEN 'UNKNOWN' THEN '⏳ Checking...' ELSE mergeable END AS mergeable_label,
  CASE WHEN len(base) = 0 AND n_pending > 0
       THEN ['**' || CAST(n_pending AS VARCHAR) || ' check(s) still running** - Wait for completion'] ELSE base END AS issues
FROM (
  SELECT p.project, p.number, p.head_ref, p.mergeable, coalesce(c.n_pending, 0) AS n_pending,
    list_filter([
      CASE WHEN upper(p.mergeable) = 'CONFLICTING' THEN '**Merge conflicts** - Resolve conflicts with the base branch' END,
      CASE WHEN coalesce(c.n_failing, 0) > 0 THEN '**CI failures** - Fix: ' || c.failing_names END,
      CASE WHEN r.requester IS NOT NULL THEN '**Changes requested** by @' || r.requester END,
      CASE WHEN coalesce(m.n, 0) > 0 THEN '**' || CAST(m.n AS VARCHAR) || ' review comment(s)** to address' END
    ], lambda x: x IS NOT NULL) AS base
  FROM pull_requests p
  LEFT JOIN (SELECT project, number, sum(CASE WHEN cat = 'failing' THEN 1 ELSE 0 END) AS n_failing,
               sum(CASE WHEN cat = 'pending' THEN 1 ELSE 0 END) AS n_pending,
               string_agg(name, ', ' ORDER BY seq) FILTER (WHERE cat = 'failing') AS failing_names
             FROM (SELECT *, {_CAT} AS cat FROM pr_checks) GROUP BY project, number) c ON c.project = p.project AND c.number = p.number
  LEFT JOIN (SELECT project, number, arg_min(author, seq) AS requester FROM pr_reviews
             WHERE upper(state) = 'CHANGES_REQUESTED' GROUP BY project, number) r ON r.project = p.project AND r.number = p.number
  LEFT JOIN (SELECT project, number, count(*) AS n FROM pr_comments GROUP BY project, number) m ON m.project = p.project AND m.number = p.number)
"""

_PRS = ["pull_requests", "pr_checks", "pr_reviews", "pr_comments"]
ORACLES["pr_issues"] = oracle_with(_PRS, f"SELECT *, len(issues) = 0 AS merge_ready FROM ({ISSUES})")
ORACLES["merge_ready"] = oracle_with(_PRS, f"SELECT project, number, head_ref FROM ({ISSUES}) WHERE len(issues) = 0")

CTX = """SELECT project, branch, count(DISTINCT sha) AS commits, count(DISTINCT path) AS files,
  CAST(sum(insertions) AS BIGINT) AS insertions, CAST(sum(deletions) AS BIGINT) AS deletions
FROM file_changes WHERE NOT on_base GROUP BY project, branch"""

ORACLES["review_context"] = oracle_with(["file_changes"], CTX)

ORACLES["large_prs"] = oracle_with(["pull_requests", "file_changes"], f"""
SELECT p.project, p.head_ref AS branch, p.number, x.commits, x.files, x.insertions, x.deletions,
       x.insertions + x.deletions AS lines
FROM pull_requests p JOIN ({CTX}) x ON x.project = p.project AND x.branch = p.head_ref
WHERE x.insertions + x.deletions > 500""")
