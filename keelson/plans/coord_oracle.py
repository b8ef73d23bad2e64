"""DuckDB oracle SQL for the coordination jobs."""

from __future__ import annotations

from keelson.sources.bind import oracle_with

ORACLES: dict[str, str] = {}

CLASSIFY = """
SELECT *,
  regexp_extract(thread_id, '^(.+?)(?:-(review|blocked|handoff))?$', 1) AS thread_task,
  coalesce(nullif(regexp_extract(thread_id, '^(.+?)(?:-(review|blocked|handoff))?$', 2), ''), 'work') AS thread_kind,
  CASE WHEN starts_with(subject, 'Starting') THEN 'starting'
       WHEN starts_with(subject, 'Progress') THEN 'progress'
       WHEN starts_with(subject, 'BLOCKED') THEN 'blocked'
       WHEN starts_with(subject, 'COMPLETE') THEN 'complete'
       WHEN starts_with(subject, 'Review Request') THEN 'review_request'
       WHEN starts_with(subject, 'Review In Progress') THEN 'review_claimed'
       WHEN starts_with(subject, 'Review Complete') THEN 'review_complete'
       WHEN starts_with(subject, 'Feedback Addressed') THEN 'feedback_addressed'
       WHEN starts_with(subject, 'Re-Review') THEN 're_review'
       ELSE 'other' END AS msg_kind
FROM messages"""

CM = [("cm", CLASSIFY)]

ORACLES["inbox_summary"] = oracle_with(["messages"], """
SELECT coalesce(p.project, m.project) AS project, coalesce(p.agent, m.agent) AS agent,
       coalesce(p.thread_id, m.thread_id) AS thread_id, coalesce(p.from_others, 0) AS from_others,
       p.last_ts, coalesce(m.mentions, 0) AS mentions
FROM (SELECT o.project, o.agent, o.thread_id, t.n_thread - o.n_own AS from_others, t.last_ts
      FROM (SELECT project, thread_id, from_agent AS agent, count(*) AS n_own FROM messages GROUP BY ALL) o
      JOIN (SELECT project, thread_id, count(*) AS n_thread, max(ts) AS last_ts FROM messages GROUP BY ALL) t
        ON t.project = o.project AND t.thread_id = o.thread_id) p
FULL JOIN (SELECT project, agent, thread_id, count(*) AS mentions FROM (
             SELECT project, thread_id, from_agent,
                    unnest(regexp_extract_all(body, '@([A-Za-z][A-Za-z0-9_]*)', 1)) AS agent FROM messages)
           WHERE agent <> from_agent GROUP BY ALL) m
  ON m.project = p.project AND m.agent = p.agent AND m.thread_id = p.thread_id
WHERE coalesce(p.from_others, 0) > 0 OR coalesce(m.mentions, 0) > 0""")

ORACLES["thread_messages"] = oracle_with(["messages"], """
SELECT project, thread_id, row_number() OVER (PARTITION BY project, thread_id ORDER BY ts, msg_id) AS pos,
       msg_id, from_agent, subject, thread_task, thread_kind, msg_kind, ts FROM cm""", ctes=CM)

ORACLES["search_messages"] = oracle_with(["messages"], """
SELECT project, thread_id, msg_id, from_agent, subject, ts FROM messages
WHERE (contains(lower(subject), 'review') OR contains(lower(body), 'review'))
  AND regexp_full_match(thread_id, '[^/]*-review')""")

ORACLES["escalations"] = oracle_with(["messages"], """
SELECT * FROM (
  SELECT project, count(DISTINCT CASE WHEN thread_kind = 'blocked' THEN thread_id END) AS blocked_threads,
    CAST(sum(CASE WHEN msg_kind = 'blocked' THEN 1 ELSE 0 END) AS BIGINT) AS blocked_messages,
    CAST(sum(CASE WHEN thread_kind = 'blocked' THEN 1 ELSE 0 END) AS BIGINT) AS messages_in_blocked_threads
  FROM cm GROUP BY project) WHERE blocked_threads > 0 OR blocked_messages > 0""", ctes=CM)

ORACLES["unclaimed_reviews"] = oracle_with(["messages"], """
SELECT r.project, r.thread_id, r.msg_id, r.from_agent, r.ts AS requested_ts FROM cm r
WHERE r.msg_kind = 'review_request' AND NOT EXISTS (
  SELECT 1 FROM cm c WHERE c.msg_kind = 'review_claimed' AND c.project = r.project
    AND c.thread_id = r.thread_id AND c.ts >= r.ts)""", ctes=CM)

ORACLES["overdue_reviews"] = oracle_with(["messages"], """
SELECT project, thread_id, msg_id, requested_ts, completed_ts, hours_waiting FROM (
  SELECT *, round((CAST(floor(epoch(coalesce(completed_ts, TIMESTAMP '2024-02-01 00:00:00'))) AS BIGINT)
                   - CAST(floor(epoch(requested_ts)) AS BIGINT)) / 3600.0, 4) AS hours_waiting
  FROM (SELECT r.project, r.thread_id, r.msg_id, r.ts AS requested_ts,
          (SELECT min(c.ts) FROM cm c WHERE c.msg_kind = 'review_complete' AND c.project = r.project
             AND c.thread_id = r.thread_id AND c.ts >= r.ts) AS completed_ts
        FROM cm r WHERE r.msg_kind = 'review_request'))
WHERE hours_waiting > 24""", ctes=CM)

ORACLES["review_load"] = oracle_with(["messages"], """
SELECT agent, msg_id, ts, load FROM (
  SELECT from_agent AS agent, msg_id, ts,
    CAST(sum(CASE WHEN msg_kind = 'review_claimed' THEN 1 ELSE -1 END)
         OVER (PARTITION BY from_agent ORDER BY ts, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS load
  FROM cm WHERE msg_kind IN ('review_claimed', 'review_complete')) WHERE load > 3""", ctes=CM)

ORACLES["task_cycle_time"] = oracle_with(["status_events"], """
SELECT project, label, count(*) AS tasks, round(avg(hours), 4) AS avg_hours, round(min(hours), 4) AS min_hours,
       round(max(hours), 4) AS max_hours, round(quantile_cont(hours, 0.5), 4) AS median_hours,
       round(quantile_cont(hours, 0.9), 4) AS p90_hours, CAST(GROUPING(project, label) AS INT) AS level
FROM (SELECT s.project, s.task_id, s.label,
        (CAST(floor(epoch(min(e.ts))) AS BIGINT) - CAST(floor(epoch(s.start_ts)) AS BIGINT)) / 3600.0 AS hours
      FROM (SELECT project, task_id, min(label) AS label, min(ts) AS start_ts FROM status_events WHERE status = 'in_progress'
            GROUP BY project, task_id) s
      JOIN status_events e ON e.project = s.project AND e.task_id = s.task_id
        AND e.status = 'closed' AND e.ts >= s.start_ts
      GROUP BY s.project, s.task_id, s.label, s.start_ts)
GROUP BY GROUPING SETS ((project, label), (project), (label), ())""")

ITEMS = [
    ("ln", """SELECT project, thread_id, msg_id, pos, line,
                last_value(CASE WHEN h <> '' THEN h END IGNORE NULLS) OVER (
                  PARTITION BY project, thread_id, msg_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading
              FROM (SELECT project, thread_id, msg_id, pos, line, regexp_extract(line, '^#{2,3}\\s+(.+?)\\s*$', 1) AS h FROM (
                      SELECT project, thread_id, msg_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
                      FROM (SELECT project, thread_id, msg_id, string_split(body, chr(10)) AS parts FROM review_posts)))"""),
    ("items", """SELECT * FROM (
                   SELECT project, thread_id, msg_id, CAST(pos AS BIGINT) AS pos, heading,
                     CAST(regexp_extract(line, '^\\s*(\\d+)\\.\\s+(.*)$', 1) AS BIGINT) AS item_no,
                     regexp_extract(line, '^\\s*(\\d+)\\.\\s+(.*)$', 2) AS text,
                     CASE heading WHEN 'Blocking Issues' THEN 'blocking' WHEN 'Suggestions' THEN 'suggestion'
                       WHEN 'Questions' THEN 'question' WHEN 'Nitpicks' THEN 'nitpick' WHEN 'Highlights' THEN 'praise'
                       END AS category
                   FROM ln WHERE regexp_matches(line, '^\\s*(\\d+)\\.\\s+(.*)$'))
                 WHERE category IS NOT NULL"""),
    ("fi", """SELECT *, CAST(CASE category WHEN 'blocking' THEN 0 WHEN 'suggestion' THEN 1 WHEN 'question' THEN 2
                                WHEN 'nitpick' THEN 3 WHEN 'praise' THEN 4 END AS INT) AS priority FROM items"""),
]

ORACLES["feedback_items"] = oracle_with(["review_posts"], "SELECT * FROM fi", ctes=ITEMS)

ORACLES["verdicts"] = oracle_with(["review_posts"], """
SELECT p.project, p.msg_id, p.thread_id, p.stated, coalesce(c.blocking, 0) AS blocking, coalesce(c.other_items, 0) AS other_items,
  CASE WHEN coalesce(c.blocking, 0) > 0 THEN 'Changes Requested'
       WHEN coalesce(c.other_items, 0) > 0 THEN 'Approved with Comments' ELSE 'Approved' END AS derived,
  p.stated = CASE WHEN coalesce(c.blocking, 0) > 0 THEN 'Changes Requested'
       WHEN coalesce(c.other_items, 0) > 0 THEN 'Approved with Comments' ELSE 'Approved' END AS consistent
FROM (SELECT project, thread_id, msg_id, trim(regexp_extract(body, '\\*\\*Verdict\\*\\*:\\s*([^\\n]+)', 1)) AS stated
      FROM review_posts) p
LEFT JOIN (SELECT project, thread_id, msg_id, CAST(sum(CASE WHEN category = 'blocking' THEN 1 ELSE 0 END) AS BIGINT) AS blocking,
             CAST(sum(CASE WHEN category IN ('suggestion', 'question', 'nitpick') THEN 1 ELSE 0 END) AS BIGINT) AS other_items
           FROM fi GROUP BY project, thread_id, msg_id) c ON c.project = p.project AND c.thread_id = p.thread_id AND c.msg_id = p.msg_id""", ctes=ITEMS)

ORACLES["unresolved_feedback"] = oracle_with(["review_posts", "resolution_posts"], """
SELECT * FROM fi WHERE category <> 'praise' AND NOT EXISTS (
  SELECT 1 FROM (SELECT project, thread_id, unnest(string_split(body, chr(10))) AS line FROM resolution_posts) r
  WHERE regexp_matches(r.line, '^\\s*-\\s*\\[[xX]\\]\\s*#(\\d+)') AND r.project = fi.project AND r.thread_id = fi.thread_id
    AND CAST(regexp_extract(r.line, '^\\s*-\\s*\\[[xX]\\]\\s*#(\\d+)', 1) AS BIGINT) = fi.item_no)""", ctes=ITEMS)

ACTIVE = """SELECT *, start_ts + to_seconds(ttl_seconds) AS end_ts FROM reservations
WHERE (released_ts IS NULL OR released_ts > TIMESTAMP '2024-01-10 00:00:00') AND start_ts <= TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00' < start_ts + to_seconds(ttl_seconds)"""

ORACLES["active_reservations"] = oracle_with(["reservations"], ACTIVE)

# Two globs name a common path if their automata can read one text to both ends: all reachable
# (place in a, place in b), found step by step. gi / gj: inside the folders that '**/' stands for.
_READS = """CASE WHEN {g} THEN [{{'c': 'ANY', 'p': {p}, 'g': true}}, {{'c': '/', 'p': {p} + 1, 'g': false}}]
      WHEN {x} = '*' THEN [{{'c': 'SEG', 'p': {p}, 'g': false}}] WHEN {x} = chr(1) THEN [{{'c': 'ANY', 'p': {p}, 'g': false}}]
      WHEN {x} = '?' THEN [{{'c': 'SEG', 'p': {p} + 1, 'g': false}}]
      WHEN {x} NOT IN ('', chr(2)) THEN [{{'c': {x}, 'p': {p} + 1, 'g': false}}] END"""
_GLOB_WALK = [
    ("pp", """SELECT DISTINCT x, y, replace(replace(x, '**/', chr(2)), '**', chr(1)) AS pa,
                replace(replace(y, '**/', chr(2)), '**', chr(1)) AS pb FROM cand"""),
    ("walk", f"""
SELECT DISTINCT pa, pb, CAST(1 AS BIGINT) AS i, false AS gi, CAST(1 AS BIGINT) AS j, false AS gj FROM pp
UNION
SELECT pa, pb, m.i, m.gi, m.j, m.gj FROM (
  SELECT pa, pb, unnest(list_concat(
      CASE WHEN NOT gi AND x IN ('*', chr(1), chr(2)) THEN [{{'i': i + 1, 'gi': false, 'j': j, 'gj': gj}}] ELSE [] END,
      CASE WHEN NOT gi AND x = chr(2) THEN [{{'i': i, 'gi': true, 'j': j, 'gj': gj}}] ELSE [] END,
      CASE WHEN NOT gj AND y IN ('*', chr(1), chr(2)) THEN [{{'i': i, 'gi': gi, 'j': j + 1, 'gj': false}}] ELSE [] END,
      CASE WHEN NOT gj AND y = chr(2) THEN [{{'i': i, 'gi': gi, 'j': j, 'gj': true}}] ELSE [] END,
      flatten(list_transform(ra, lambda r: list_transform(
        list_filter(rb, lambda s: r.c = s.c OR r.c = 'ANY' OR s.c = 'ANY' OR (r.c = 'SEG' AND s.c <> '/') OR (s.c = 'SEG' AND r.c <> '/')),
        lambda s: {{'i': r.p, 'gi': r.g, 'j': s.p, 'gj': s.g}}))))) AS m
  FROM (SELECT *, {_READS.format(g="gi", x="x", p="i")} AS ra, {_READS.format(g="gj", x="y", p="j")} AS rb
        FROM (SELECT *, substr(pa, i, 1) AS x, substr(pb, j, 1) AS y FROM walk)))"""),
    ("meet", """SELECT DISTINCT pp.x, pp.y FROM pp JOIN walk w ON w.pa = pp.pa AND w.pb = pp.pb
                WHERE NOT gi AND NOT gj AND i = length(w.pa) + 1 AND j = length(w.pb) + 1"""),
]
ORACLES["reservation_conflicts"] = oracle_with(["reservations"], """
SELECT c.project, res_a, res_b, agent_a, agent_b, overlap_start, overlap_end
FROM cand c JOIN meet m ON m.x = c.x AND m.y = c.y""",
    ctes=[("r", """SELECT *, least(start_ts + to_seconds(ttl_seconds), released_ts) AS end_ts FROM reservations"""),
          ("cand", """SELECT a.project, a.reservation_id AS res_a, b.reservation_id AS res_b, a.agent AS agent_a, b.agent AS agent_b,
                        greatest(a.start_ts, b.start_ts) AS overlap_start, least(a.end_ts, b.end_ts) AS overlap_end,
                        a.pattern AS x, b.pattern AS y
                      FROM r a JOIN r b ON a.project = b.project AND a.reservation_id < b.reservation_id
                        AND a.agent <> b.agent AND (a.exclusive OR b.exclusive)
                        AND a.start_ts < b.end_ts AND b.start_ts < a.end_ts
                        AND a.start_ts < a.end_ts AND b.start_ts < b.end_ts""")] + _GLOB_WALK, recursive=True)

_REGEX = r"""replace(replace(replace(replace(replace(regexp_replace(a.pattern, '([\\.+^$(){}|\[\]])', '\\\1', 'g'),
    '**/', chr(2)), '**', chr(1)), '*', '[^/]*'), '?', '[^/]'), chr(2), '(?:.*/)?')"""
ORACLES["file_conflicts"] = oracle_with(["porcelain_lines", "reservations"], f"""
SELECT f.project, f.path, f.agent AS changed_by, a.reservation_id, a.agent, a.pattern, a.exclusive
FROM (SELECT DISTINCT project, path, agent FROM porcelain_lines) f JOIN act a ON a.project = f.project AND a.agent <> f.agent
WHERE regexp_matches(f.path, '^' || replace({_REGEX}, chr(1), '.*') || '$')""", ctes=[("act", ACTIVE)])

ORACLES["loop_iterations"] = oracle_with(["loop_commits"], """
SELECT * FROM (
  SELECT project, iteration, summary, seq, prev_iteration,
    CASE WHEN prev_iteration IS NULL THEN NULL WHEN iteration = prev_iteration THEN 'repeat'
         WHEN iteration > prev_iteration + 1 THEN 'gap' WHEN iteration < prev_iteration THEN 'backwards' END AS issue
  FROM (SELECT project, seq,
          CAST(regexp_extract(subject, '^ralph: iteration (\\d+) - (.*)$', 1) AS BIGINT) AS iteration,
          regexp_extract(subject, '^ralph: iteration (\\d+) - (.*)$', 2) AS summary,
          lag(CAST(regexp_extract(subject, '^ralph: iteration (\\d+) - (.*)$', 1) AS BIGINT))
            OVER (PARTITION BY project ORDER BY seq) AS prev_iteration
        FROM loop_commits WHERE regexp_matches(subject, '^ralph: iteration (\\d+) - (.*)$')))
WHERE issue IS NOT NULL""")

ORACLES["loop_completion"] = oracle_with(["loop_runs"], """
SELECT *, coalesce(completed_at, iterations) > 30 AS over_limit, completed_at IS NOT NULL AS completed FROM (
  SELECT project,
    min(CASE WHEN exit_code = 0 AND contains(output, '<promise>COMPLETE</promise>') THEN iteration END) AS completed_at,
    count(*) AS iterations,
    CAST(sum(CASE WHEN contains(output, '<promise>COMPLETE</promise>') AND exit_code <> 0 THEN 1 ELSE 0 END) AS BIGINT)
      AS promise_without_tests
  FROM loop_runs GROUP BY project)""")

ORACLES["delivery_check"] = oracle_with(["messages", "agent_policies", "agent_contacts"], """
SELECT m.project, m.thread_id, m.msg_id, m.from_agent, m.recipient, coalesce(p.contact_policy, 'auto') AS policy,
  CASE coalesce(p.contact_policy, 'auto') WHEN 'open' THEN true WHEN 'auto' THEN true
       WHEN 'contacts_only' THEN EXISTS (SELECT 1 FROM agent_contacts c WHERE c.agent = m.recipient AND c.contact = m.from_agent)
       ELSE false END AS allowed
FROM (SELECT project, thread_id, msg_id, from_agent,
        lag(from_agent) OVER (PARTITION BY project, thread_id ORDER BY ts, msg_id) AS recipient FROM messages) m
LEFT JOIN agent_policies p ON p.agent = m.recipient
WHERE m.recipient IS NOT NULL AND m.recipient <> m.from_agent""")
