"""DuckDB oracle SQL for ingestion and validation jobs.

The oracle does not parse YAML: it states, from the task table, what the
flattened files must contain (ids, titles, labels, positions, raw fields).
"""

from __future__ import annotations

from keelson.sources.bind import oracle_with

T = ["tasks", "task_deps"]

NORM = [
    ("b1", """SELECT t.*, CAST(floor((seq - 1) / 20) AS BIGINT) AS file_no,
                CAST(floor((seq - 1) / 20) AS BIGINT) % 3 AS shape_i,
                'tasks/' || project || '/' || CAST(CAST(floor((seq - 1) / 20) AS BIGINT) AS VARCHAR) || '.yaml' AS path
              FROM tasks t"""),
    ("pk", """SELECT path, label, row_number() OVER (PARTITION BY path ORDER BY min(seq), label) AS k
              FROM b1 GROUP BY path, label"""),
    ("b2", """SELECT b1.*, pk.k,
                row_number() OVER (PARTITION BY b1.path, b1.label ORDER BY b1.seq) - 1 AS tpos,
                row_number() OVER (PARTITION BY b1.path ORDER BY pk.k, b1.seq) - 1 AS fpos
              FROM b1 JOIN pk ON pk.path = b1.path AND pk.label = b1.label"""),
    ("dl", "SELECT project, child, list_sort(list(parent)) AS deps FROM task_deps GROUP BY project, child"),
    ("norm", """SELECT b.path, b.project,
        CASE WHEN b.shape_i = 0 AND b.priority = 3 THEN 'task-' || CAST(b.fpos AS VARCHAR) ELSE b.task_id END AS task_id,
        CASE WHEN b.label = 'not specified' THEN 'Work for ' || b.task_id ELSE b.title END AS title,
        b.priority, b.status,
        CASE b.shape_i WHEN 0 THEN CAST(b.k AS VARCHAR) WHEN 1 THEN 'bd'
             ELSE trim(regexp_replace(lower(b.label), '[^a-z0-9]+', '-', 'g'), '-') END AS label,
        CAST(CASE WHEN b.shape_i = 1 THEN 0 ELSE b.k - 1 END AS BIGINT) AS phase_pos,
        CAST(CASE WHEN b.shape_i = 1 THEN b.fpos ELSE b.tpos END AS BIGINT) AS task_pos,
        CAST(b.fpos AS BIGINT) AS idx,
        coalesce(d.deps, []) AS dependencies,
        CASE b.shape_i WHEN 0 THEN 'phases' WHEN 1 THEN 'flat' ELSE 'keyed' END AS shape,
        NOT (b.shape_i = 0 AND b.priority = 3) AS has_id,
        b.label <> 'not specified' AS has_name,
        b.label = 'not specified' AS has_description,
        CASE b.priority WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS raw_priority,
        CASE b.status WHEN 'open' THEN 'pending' WHEN 'in_progress' THEN 'in-progress' ELSE 'completed' END AS raw_status,
        b.shape_i
      FROM b2 b LEFT JOIN dl d ON d.project = b.project AND d.child = b.task_id"""),
    ("edges", """SELECT * FROM (
        SELECT path, project, task_id AS child, idx, unnest(dependencies) AS parent,
               CAST(unnest(range(len(dependencies))) AS BIGINT) AS dep_pos FROM norm) e
      WHERE EXISTS (SELECT 1 FROM norm n WHERE n.path = e.path AND n.task_id = e.parent)"""),
]

NORM_COLS = ("path, project, task_id, title, priority, status, label, phase_pos, task_pos, idx, dependencies, "
             "shape, has_id, has_name, has_description, raw_priority, raw_status")

ORACLES: dict[str, str] = {}

ORACLES["normalize_tasks"] = oracle_with(T, f"SELECT {NORM_COLS} FROM norm", ctes=NORM)

ORACLES["scanned_tasks"] = ORACLES["written_tasks"] = ORACLES["normalize_tasks"]

ORACLES["validate_drafts"] = oracle_with(["draft_tasks"], """
SELECT project, 'V1_duplicate_id' AS rule, task_id, path || ' x' || CAST(count(*) AS VARCHAR) AS detail
FROM draft_tasks GROUP BY project, path, task_id HAVING count(*) > 1
UNION ALL
SELECT project, 'V3_priority', task_id, raw_priority FROM draft_tasks WHERE raw_priority = 'someday'
UNION ALL
SELECT project, 'V3_status', task_id, raw_status FROM draft_tasks WHERE raw_status = 'done?'
UNION ALL
SELECT project, 'V8_not_kebab_case', task_id, task_id FROM draft_tasks WHERE starts_with(task_id, 'BD_')""")

ORACLES["draft_reconcile"] = oracle_with(["draft_tasks", "tasks"], """
SELECT coalesce(s.project, t.project) AS project,
  CAST(sum(coalesce(s.n_src, 0)) AS BIGINT) AS source_tasks, CAST(sum(coalesce(t.n_tgt, 0)) AS BIGINT) AS target_tasks,
  CAST(sum(CASE WHEN t.n_tgt IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
  CAST(sum(CASE WHEN s.n_src IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra,
  CAST(sum(CASE WHEN s.n_src > 1 OR t.n_tgt > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
  CAST(sum(CASE WHEN s.s_status <> t.t_status THEN 1 ELSE 0 END) AS BIGINT) AS status_mismatch
FROM (SELECT project, task_id, count(*) AS n_src, max(status) AS s_status FROM draft_tasks GROUP BY 1, 2) s
FULL JOIN (SELECT project, task_id, count(*) AS n_tgt, max(status) AS t_status FROM tasks GROUP BY 1, 2) t
  ON s.project = t.project AND s.task_id = t.task_id
GROUP BY coalesce(s.project, t.project)""")

ORACLES["dependency_edges"] = oracle_with(T, "SELECT path, parent, project, child, idx, dep_pos FROM edges", ctes=NORM)

ORACLES["migration_actions"] = oracle_with(T, """
SELECT path, project, 1 AS step, idx, CAST(0 AS BIGINT) AS dep_pos, 'create' AS action, task_id,
       CAST(NULL AS VARCHAR) AS parent, title, priority, label FROM norm
UNION ALL
SELECT path, project, 2, idx, dep_pos, 'add_dependency', child, parent, NULL, NULL, NULL FROM edges
UNION ALL
SELECT path, project, 3, idx, 0, 'close', task_id, NULL, NULL, NULL, NULL FROM norm WHERE status = 'closed'""",
    ctes=NORM)

ORACLES["migration_reconcile"] = oracle_with(T, """
SELECT coalesce(s.project, t.project) AS project,
  CAST(sum(coalesce(s.n_src, 0)) AS BIGINT) AS source_tasks, CAST(sum(coalesce(t.n_tgt, 0)) AS BIGINT) AS target_tasks,
  CAST(sum(CASE WHEN t.n_tgt IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
  CAST(sum(CASE WHEN s.n_src IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra,
  CAST(sum(CASE WHEN s.n_src > 1 OR t.n_tgt > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
  CAST(sum(CASE WHEN s.s_status <> t.t_status THEN 1 ELSE 0 END) AS BIGINT) AS status_mismatch
FROM (SELECT project, task_id, count(*) AS n_src, max(status) AS s_status FROM norm GROUP BY 1, 2) s
FULL JOIN (SELECT project, task_id, count(*) AS n_tgt, max(status) AS t_status FROM tasks GROUP BY 1, 2) t
  ON s.project = t.project AND s.task_id = t.task_id
GROUP BY coalesce(s.project, t.project)""", ctes=NORM)

ORACLES["approx_task_count"] = oracle_with(T, """
SELECT path, CAST(lines AS BIGINT) AS lines, CAST(lines // 2 AS BIGINT) AS approx_tasks FROM (
  SELECT path, CASE max(shape_i)
      WHEN 0 THEN count(DISTINCT phase_pos) + sum(CASE WHEN has_id THEN 1 ELSE 0 END) + count(*)
      WHEN 1 THEN 2 * count(*)
      ELSE count(DISTINCT phase_pos) + count(*) END AS lines
  FROM norm GROUP BY path)""", ctes=NORM)

ORACLES["external_dependencies"] = oracle_with(T, """
SELECT path, CAST(dense_rank() OVER (PARTITION BY path ORDER BY ppath) - 1 AS BIGINT) AS pos,
       regexp_extract(ppath, '^tasks/([^/]+)/', 1) AS ext_project, ppath AS location,
       'cross-file dependency' AS purpose, parent AS task
FROM (SELECT DISTINCT c.path, p.path AS ppath, d.parent FROM task_deps d
      JOIN b1 c ON c.project = d.project AND c.task_id = d.child
      JOIN b1 p ON p.project = d.project AND p.task_id = d.parent
      WHERE p.path <> c.path)""", ctes=NORM)

ORACLES["update_log"] = oracle_with(T + ["orders"], """
SELECT b.path, CAST(row_number() OVER (PARTITION BY b.path ORDER BY b.seq, b.task_id) - 1 AS BIGINT) AS pos,
       CAST(o.o_orderdate AS DATE) AS date, 'closed ' || b.task_id AS text
FROM b1 b JOIN orders o ON 'p' || CAST(o.o_custkey AS VARCHAR) = b.project AND 'bd-' || CAST(o.o_orderkey AS VARCHAR) = b.task_id
WHERE b.shape_i = 0 AND b.status = 'closed'""", ctes=NORM)

AGENTS = """SELECT 'u' || CAST(user_id % 120 AS VARCHAR) AS name,
  ['review', 'implementation', 'testing'][user_id % 3 + 1] AS type,
  CASE WHEN user_id % 2 = 0 THEN 'global' ELSE 'per-repo' END AS scope,
  CASE WHEN user_id % 2 = 1 THEN 'p' || CAST(user_id % 10 AS VARCHAR) END AS repo,
  ['open', 'auto', 'contacts_only', 'block_all'][user_id % 4 + 1] AS contact_policy,
  count(DISTINCT event_type) AS n_capabilities, 3 AS max_concurrent, 24 AS timeout_hours,
  date_trunc('second', min(ts)) AS created_at
FROM events GROUP BY user_id"""

ORACLES["agent_registry"] = oracle_with(["events"], AGENTS)

ORACLES["agent_capabilities"] = oracle_with(["events"], """
SELECT 'u' || CAST(user_id % 120 AS VARCHAR) AS name,
  CASE WHEN user_id % 2 = 0 THEN 'global' ELSE 'per-repo' END AS scope, event_type AS capability
FROM (SELECT DISTINCT user_id, event_type FROM events)""")

ORACLES["agent_behavior"] = oracle_with(["events"], """
SELECT 'u' || CAST(user_id % 120 AS VARCHAR) AS name, CASE WHEN user_id % 2 = 0 THEN 'global' ELSE 'per-repo' END AS scope, key, kind, value
FROM (SELECT DISTINCT user_id FROM events) u, LATERAL (
  SELECT 'max_concurrent_reviews' AS key, 'bigint' AS kind, '3' AS value
  UNION ALL SELECT 'review_timeout_hours', 'bigint', '24'
  UNION ALL SELECT 'auto_claim_reviews', 'boolean', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
  UNION ALL SELECT 'feedback_format', 'string', 'structured-markdown' WHERE user_id % 3 = 0
  UNION ALL SELECT 'quiet_hours', 'object<from: bigint, zone: string>',
                   '{"from":' || CAST(user_id % 24 AS VARCHAR) || ',"zone":"utc"}' WHERE user_id % 5 = 0)""")

ORACLES["duplicate_agent_names"] = oracle_with(["events"], f"""
SELECT scope, coalesce(repo, '') AS repo, name, count(*) AS n FROM ({AGENTS})
GROUP BY scope, coalesce(repo, ''), name HAVING count(*) > 1""")

ORACLES["validate_tasks"] = oracle_with(T, """
SELECT project, 'V1_duplicate_id' AS rule, task_id, path || ' x' || CAST(count(*) AS VARCHAR) AS detail
FROM norm GROUP BY project, path, task_id HAVING count(*) > 1
UNION ALL
SELECT project, 'V2_missing_field', task_id, 'id' FROM norm WHERE NOT has_id
UNION ALL
SELECT project, 'V2_missing_field', task_id, 'name' FROM norm WHERE NOT has_name
UNION ALL
SELECT project, 'V2_missing_field', task_id, 'description' FROM norm WHERE NOT has_description
UNION ALL
SELECT project, 'V3_priority', task_id, raw_priority FROM norm
WHERE lower(raw_priority) NOT IN ('critical', 'high', 'medium', 'low')
UNION ALL
SELECT project, 'V3_status', task_id, raw_status FROM norm
WHERE lower(raw_status) NOT IN ('pending', 'in-progress', 'completed', 'blocked')
UNION ALL
SELECT e.project, 'V4_unknown_dependency', e.task_id, e.parent FROM (
  SELECT path, project, task_id, unnest(dependencies) AS parent FROM norm) e
WHERE NOT EXISTS (SELECT 1 FROM norm n WHERE n.path = e.path AND n.task_id = e.parent)
UNION ALL
SELECT project, 'V6_phase_size', path || '#' || CAST(phase_pos AS VARCHAR),
       label || ': ' || CAST(count(*) AS VARCHAR) || ' tasks'
FROM norm WHERE shape <> 'flat' GROUP BY project, path, phase_pos, label HAVING count(*) < 3 OR count(*) > 10
UNION ALL
SELECT project, 'V8_not_kebab_case', task_id, task_id FROM norm WHERE NOT regexp_full_match(task_id, '[a-z0-9]+(-[a-z0-9]+)*')
UNION ALL
SELECT d.project, 'V11_unfinished_dependency', d.child,
       c.status || ' waits for ' || d.parent || ' (' || p.status || ')'
FROM task_deps d JOIN tasks c ON c.project = d.project AND c.task_id = d.child
JOIN tasks p ON p.project = d.project AND p.task_id = d.parent
WHERE c.status IN ('in_progress', 'closed') AND p.status <> 'closed'""", ctes=NORM)

ORACLES["oversized_tasks"] = oracle_with(["file_changes"], """
SELECT project, task_id, lines FROM (
  SELECT project, regexp_extract(branch, '(bd-\\d+)', 1) AS task_id,
         CAST(sum(insertions + deletions) AS BIGINT) AS lines
  FROM file_changes WHERE regexp_extract(branch, '(bd-\\d+)', 1) <> '' GROUP BY 1, 2) WHERE lines > 750""")

ORACLES["multi_claims"] = oracle_with(["status_events"], """
SELECT agent, project, task_id, event_id, start_ts, end_ts FROM (
  SELECT *, max(coalesce(end_ts, TIMESTAMP '9999-12-31 00:00:00')) OVER (
      PARTITION BY agent ORDER BY start_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM (SELECT agent, project, task_id, event_id, ts AS start_ts, next_ts AS end_ts FROM (
          SELECT *, lead(ts) OVER (PARTITION BY project, task_id ORDER BY ts, event_id) AS next_ts FROM status_events)
        WHERE status = 'in_progress'))
WHERE prev_end > start_ts""")

ORACLES["new_task_status"] = oracle_with(T, """
SELECT n.project, 'V7_new_task_not_pending' AS rule, n.task_id, coalesce(n.raw_status, '') AS detail FROM norm n
WHERE NOT EXISTS (SELECT 1 FROM tasks t WHERE t.project = n.project AND t.task_id = n.task_id)
  AND lower(coalesce(n.raw_status, 'pending')) <> 'pending'""", ctes=NORM)
