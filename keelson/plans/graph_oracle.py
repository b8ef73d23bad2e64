"""DuckDB oracle SQL for the task-graph jobs (written as plain SQL, with
recursive CTEs where the Spark side iterates)."""

from __future__ import annotations

from keelson.sources.bind import oracle_with

T = ["tasks", "task_deps"]
TB = ["tasks", "task_deps", "back_edges"]

READY = """
SELECT t.project, t.task_id, t.title, t.priority, t.label, t.seq FROM tasks t
WHERE t.status = 'open' AND NOT EXISTS (
  SELECT 1 FROM task_deps d JOIN tasks p ON p.project = d.project AND p.task_id = d.parent
  WHERE d.project = t.project AND d.child = t.task_id AND p.status <> 'closed')
"""

OPEN_EDGES = [
    ("nc", "SELECT project, task_id FROM tasks WHERE status <> 'closed'"),
    ("oe", """SELECT d.project, d.child, d.parent FROM task_deps d
              JOIN nc c ON c.project = d.project AND c.task_id = d.child
              JOIN nc p ON p.project = d.project AND p.task_id = d.parent"""),
]

LEVELS = OPEN_EDGES + [
    ("walk", """SELECT project, task_id, CAST(1 AS BIGINT) AS level FROM nc
                UNION
                SELECT w.project, e.child, w.level + 1 FROM walk w
                JOIN oe e ON e.project = w.project AND e.parent = w.task_id"""),
    ("lv", "SELECT project, task_id, max(level) AS level FROM walk GROUP BY project, task_id"),
]

REACH = OPEN_EDGES + [
    ("reach", """SELECT project, parent AS task_id, child AS dependent FROM oe
                 UNION
                 SELECT r.project, r.task_id, e.child FROM reach r
                 JOIN oe e ON e.project = r.project AND e.parent = r.dependent"""),
]


def pagerank_ctes(d: float = 0.85, iters: int = 20):
    damp = repr(d)
    base = repr(1 - d)
    ctes = [
        ("pn", "SELECT project, CAST(count(*) AS DOUBLE) AS n FROM tasks GROUP BY project"),
        ("pe", """SELECT DISTINCT d.project, d.child, d.parent FROM task_deps d
                  WHERE EXISTS (SELECT 1 FROM tasks t WHERE t.project = d.project AND t.task_id = d.child)
                    AND EXISTS (SELECT 1 FROM tasks t WHERE t.project = d.project AND t.task_id = d.parent)"""),
        ("pod", "SELECT project, child, CAST(count(*) AS DOUBLE) AS outdeg FROM pe GROUP BY project, child"),
        ("pnodes", """SELECT t.project, t.task_id, pn.n, pod.outdeg FROM (SELECT DISTINCT project, task_id FROM tasks) t
                      JOIN pn ON pn.project = t.project
                      LEFT JOIN pod ON pod.project = t.project AND pod.child = t.task_id"""),
        ("r0", "SELECT project, task_id, 1.0 / n AS rank FROM pnodes"),
    ]
    for i in range(iters):
        ctes.append((f"r{i + 1}", f"""
SELECT nd.project, nd.task_id,
       CAST({base} AS DOUBLE) / nd.n + CAST({damp} AS DOUBLE) * (coalesce(c.c, 0.0) + coalesce(dm.dm, 0.0) / nd.n) AS rank
FROM pnodes nd
LEFT JOIN (SELECT e.project, e.parent AS task_id, sum(r.rank / o.outdeg) AS c
           FROM r{i} r JOIN pe e ON e.project = r.project AND e.child = r.task_id
           JOIN pod o ON o.project = e.project AND o.child = e.child
           GROUP BY e.project, e.parent) c ON c.project = nd.project AND c.task_id = nd.task_id
LEFT JOIN (SELECT r.project, sum(r.rank) AS dm FROM r{i} r
           JOIN pnodes x ON x.project = r.project AND x.task_id = r.task_id
           WHERE x.outdeg IS NULL GROUP BY r.project) dm ON dm.project = nd.project"""))
    ctes.append(("pr", f"SELECT * FROM r{iters}"))
    return ctes


def _cycle_ctes():
    return [
        ("ce", "SELECT DISTINCT project, child, parent FROM (SELECT * FROM task_deps UNION ALL SELECT * FROM back_edges)"),
        ("creach", """SELECT project, child AS src, parent AS dst FROM ce
                      UNION
                      SELECT r.project, r.src, e.parent FROM creach r
                      JOIN ce e ON e.project = r.project AND e.child = r.dst"""),
        ("cyc", "SELECT DISTINCT project, src AS task_id FROM creach WHERE src = dst"),
    ]


ORACLES: dict[str, str] = {}

ORACLES["ready_tasks"] = oracle_with(T, READY)

ORACLES["next_tasks"] = oracle_with(T, f"""
SELECT * FROM (
  SELECT r.*, row_number() OVER (PARTITION BY project ORDER BY priority, seq, task_id) AS rank
  FROM ({READY}) r) WHERE rank <= 1""")

ORACLES["blocked_tasks"] = oracle_with(T, """
SELECT *, count(*) OVER (PARTITION BY project, task_id) AS n_blockers FROM (
  SELECT d.project, d.child AS task_id, c.status, c.priority, d.parent AS blocked_by, p.status AS blocker_status
  FROM task_deps d
  JOIN tasks p ON p.project = d.project AND p.task_id = d.parent AND p.status <> 'closed'
  JOIN tasks c ON c.project = d.project AND c.task_id = d.child AND c.status <> 'closed')""")

ORACLES["newly_unblocked"] = oracle_with(T, f"""
SELECT a.* FROM ({READY.replace('tasks t', 'after_t t').replace('tasks p', 'after_t p')}) a
WHERE NOT EXISTS (SELECT 1 FROM ({READY}) b WHERE b.project = a.project AND b.task_id = a.task_id)
  AND EXISTS (SELECT 1 FROM task_deps d JOIN tasks x ON x.project = d.project AND x.task_id = d.parent
              WHERE x.status = 'in_progress' AND d.project = a.project AND d.child = a.task_id)""",
    ctes=[("after_t", """SELECT project, task_id, title,
            CASE WHEN status = 'in_progress' THEN 'closed' ELSE status END AS status,
            priority, label, seq FROM tasks""")])

ORACLES["status_counts"] = oracle_with(["tasks"], """
SELECT project,
  CAST(sum(CASE WHEN status = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open,
  CAST(sum(CASE WHEN status = 'in_progress' THEN 1 ELSE 0 END) AS BIGINT) AS in_progress,
  CAST(sum(CASE WHEN status = 'closed' THEN 1 ELSE 0 END) AS BIGINT) AS closed,
  CAST(count(*) AS BIGINT) AS total
FROM tasks GROUP BY project""")

ORACLES["progress_report"] = oracle_with(T, f"""
SELECT project, label, count(*) AS total,
  CAST(sum(CASE WHEN status = 'closed' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  CAST(sum(CASE WHEN status = 'in_progress' THEN 1 ELSE 0 END) AS BIGINT) AS in_progress,
  CAST(sum(is_blocked) AS BIGINT) AS blocked,
  CAST(sum(is_ready) AS BIGINT) AS ready,
  round(CAST(sum(CASE WHEN status = 'closed' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 2) AS pct_complete
FROM (
  SELECT t.project, t.label, t.status,
    CASE WHEN t.status <> 'closed' AND EXISTS (
      SELECT 1 FROM task_deps d JOIN tasks p ON p.project = d.project AND p.task_id = d.parent
      WHERE d.project = t.project AND d.child = t.task_id AND p.status <> 'closed') THEN 1 ELSE 0 END AS is_blocked,
    CASE WHEN EXISTS (SELECT 1 FROM ({READY}) r WHERE r.project = t.project AND r.task_id = t.task_id)
         THEN 1 ELSE 0 END AS is_ready
  FROM tasks t) x
GROUP BY ROLLUP (project, label)""")

ORACLES["priority_distribution"] = oracle_with(["tasks"], """
SELECT project, priority, n, round(n / sum(n) OVER (PARTITION BY project), 6) AS share
FROM (SELECT project, priority, count(*) AS n FROM tasks GROUP BY project, priority)""")

ORACLES["cycle_members"] = oracle_with(TB, "SELECT project, task_id FROM cyc", ctes=_cycle_ctes(), recursive=True)

ORACLES["graph_tree"] = oracle_with(T, """
SELECT lv.project, lv.task_id, lv.level,
       coalesce(p.parents, []) AS parents,
       CAST(coalesce(len(p.parents), 0) AS BIGINT) AS n_parents
FROM lv LEFT JOIN (SELECT project, child, list_sort(list(DISTINCT parent)) AS parents FROM oe GROUP BY project, child) p
  ON p.project = lv.project AND p.child = lv.task_id""", ctes=LEVELS, recursive=True)

ORACLES["critical_path"] = oracle_with(T, """
SELECT project, pos, task_id, length FROM path""", ctes=LEVELS + [
    ("pred", """SELECT e.project, e.child AS task_id, min(e.parent) AS pred FROM oe e
                JOIN lv c ON c.project = e.project AND c.task_id = e.child
                JOIN lv p ON p.project = e.project AND p.task_id = e.parent
                WHERE p.level = c.level - 1 GROUP BY e.project, e.child"""),
    ("ends", """SELECT project, task_id, level FROM (
                  SELECT *, row_number() OVER (PARTITION BY project ORDER BY level DESC, task_id) AS rn FROM lv)
                WHERE rn = 1"""),
    ("path", """SELECT project, task_id, level AS pos, level AS length FROM ends
                UNION ALL
                SELECT p.project, q.pred, p.pos - 1, p.length FROM path p
                JOIN pred q ON q.project = p.project AND q.task_id = p.task_id"""),
], recursive=True)

ORACLES["parallel_tracks"] = oracle_with(T, """
SELECT lv.project, lv.task_id, lv.level, t.track FROM lv
JOIN (SELECT project, task_id, min(track) AS track FROM cc GROUP BY project, task_id) t
  ON t.project = lv.project AND t.task_id = lv.task_id""", ctes=LEVELS + [
    ("und", "SELECT project, child AS a, parent AS b FROM oe UNION ALL SELECT project, parent, child FROM oe"),
    ("cc", """SELECT project, task_id, task_id AS track FROM lv
              UNION
              SELECT c.project, u.b, c.track FROM cc c JOIN und u ON u.project = c.project AND u.a = c.task_id"""),
], recursive=True)

ORACLES["blockers_to_clear"] = oracle_with(T, """
SELECT *, row_number() OVER (PARTITION BY project ORDER BY transitive_dependents DESC, task_id) AS rank FROM (
  SELECT n.project, n.task_id, n.status, n.priority,
         coalesce(dd.direct_dependents, 0) AS direct_dependents,
         coalesce(td.transitive_dependents, 0) AS transitive_dependents
  FROM tasks n
  LEFT JOIN (SELECT project, parent AS task_id, count(DISTINCT child) AS direct_dependents FROM oe GROUP BY 1, 2) dd
    ON dd.project = n.project AND dd.task_id = n.task_id
  LEFT JOIN (SELECT project, task_id, count(DISTINCT dependent) AS transitive_dependents FROM reach
             WHERE task_id <> dependent GROUP BY 1, 2) td
    ON td.project = n.project AND td.task_id = n.task_id
  WHERE n.status <> 'closed') x
WHERE transitive_dependents > 0""", ctes=REACH, recursive=True)

ORACLES["pagerank"] = oracle_with(T, "SELECT project, task_id, round(rank, 9) AS rank FROM pr",
                                  ctes=pagerank_ctes())

ORACLES["triage"] = oracle_with(T, f"""
SELECT project, task_id, priority, CAST(unblocks AS BIGINT) AS unblocks, score, reason, rank_in_project FROM (
  SELECT *, row_number() OVER (PARTITION BY project ORDER BY score DESC, priority, seq, task_id) AS rank_in_project
  FROM (
    SELECT *, round(t_unblock + t_rank + t_prio, 6) AS score,
      CASE WHEN t_unblock >= t_rank AND t_unblock >= t_prio THEN 'unblocks the most work'
           WHEN t_rank >= t_prio THEN 'central in the dependency graph'
           ELSE 'high priority' END AS reason
    FROM (
      SELECT *,
        CASE WHEN max_u > 0 THEN CAST(0.4 AS DOUBLE) * unblocks / max_u ELSE 0.0 END AS t_unblock,
        CASE WHEN max_r > 0 THEN CAST(0.3 AS DOUBLE) * rank / max_r ELSE 0.0 END AS t_rank,
        CAST(0.3 AS DOUBLE) * (3 - priority) / 3.0 AS t_prio
      FROM (
        SELECT r.project, r.task_id, r.priority, r.seq, pr.rank,
               CAST(coalesce(u.unblocks, 0) AS DOUBLE) AS unblocks,
               max(CAST(coalesce(u.unblocks, 0) AS DOUBLE)) OVER (PARTITION BY r.project) AS max_u,
               max(pr.rank) OVER (PARTITION BY r.project) AS max_r
        FROM ({READY}) r
        JOIN pr ON pr.project = r.project AND pr.task_id = r.task_id
        LEFT JOIN (SELECT project, task_id, count(DISTINCT dependent) AS unblocks FROM reach
                   WHERE task_id <> dependent GROUP BY 1, 2) u
          ON u.project = r.project AND u.task_id = r.task_id) a) b) c) d
WHERE rank_in_project <= 5""", ctes=REACH + pagerank_ctes(), recursive=True)

ORACLES["quick_wins"] = oracle_with(T, f"""
SELECT r.project, r.task_id, r.priority, coalesce(np.n_parents, 0) AS n_parents, od.open_dependents
FROM ({READY}) r
LEFT JOIN (SELECT project, child, count(*) AS n_parents FROM task_deps GROUP BY 1, 2) np
  ON np.project = r.project AND np.child = r.task_id
JOIN (SELECT project, parent, count(*) AS open_dependents FROM oe GROUP BY 1, 2) od
  ON od.project = r.project AND od.parent = r.task_id
WHERE coalesce(np.n_parents, 0) <= 1""", ctes=OPEN_EDGES)

ORACLES["project_health"] = oracle_with(TB, f"""
SELECT n.project, CAST(n.n_tasks AS BIGINT) AS n_tasks, CAST(coalesce(e.n_edges, 0) AS BIGINT) AS n_edges,
  round(CASE WHEN n.n_tasks > 1 THEN coalesce(e.n_edges, 0) / (n.n_tasks * (n.n_tasks - 1)) ELSE 0.0 END, 6) AS density,
  CAST(coalesce(c.k, 0) AS BIGINT) AS cycle_members,
  round(coalesce(r.k, 0) / n.n_tasks, 6) AS ready_ratio,
  round(coalesce(b.k, 0) / n.n_tasks, 6) AS blocked_ratio,
  round(n.n_closed / n.n_tasks, 6) AS closed_ratio,
  CAST(coalesce(dp.depth, 0) AS BIGINT) AS depth
FROM (SELECT project, count(*) AS n_tasks, sum(CASE WHEN status = 'closed' THEN 1 ELSE 0 END) AS n_closed
      FROM tasks GROUP BY project) n
LEFT JOIN (SELECT project, count(*) AS n_edges FROM task_deps GROUP BY project) e ON e.project = n.project
LEFT JOIN (SELECT project, count(*) AS k FROM cyc GROUP BY project) c ON c.project = n.project
LEFT JOIN (SELECT project, count(*) AS k FROM ({READY}) GROUP BY project) r ON r.project = n.project
LEFT JOIN (SELECT project, count(DISTINCT child) AS k FROM oe GROUP BY project) b ON b.project = n.project
LEFT JOIN (SELECT project, max(level) AS depth FROM lv GROUP BY project) dp ON dp.project = n.project""",
    ctes=LEVELS + _cycle_ctes(), recursive=True)

ORACLES["priority_misalignment"] = oracle_with(T, """
SELECT d.project, d.parent, d.child, c.priority AS child_priority, p.priority AS parent_priority,
       p.status AS parent_status
FROM task_deps d
JOIN tasks c ON c.project = d.project AND c.task_id = d.child
JOIN tasks p ON p.project = d.project AND p.task_id = d.parent
WHERE p.priority > c.priority""")

ORACLES["phase_order_violations"] = oracle_with(TB, """
SELECT d.project, d.parent, d.child, c.phase_pos AS child_phase, p.phase_pos AS parent_phase
FROM (SELECT * FROM task_deps UNION ALL SELECT * FROM back_edges) d
JOIN (SELECT project, task_id, CAST(floor((seq - 1) / 5) AS BIGINT) AS phase_pos FROM tasks) c
  ON c.project = d.project AND c.task_id = d.child
JOIN (SELECT project, task_id, CAST(floor((seq - 1) / 5) AS BIGINT) AS phase_pos FROM tasks) p
  ON p.project = d.project AND p.task_id = d.parent
WHERE p.phase_pos > c.phase_pos""")
