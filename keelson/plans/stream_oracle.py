"""DuckDB oracle SQL for the streaming jobs (the finished-input result)."""

from __future__ import annotations

from keelson.plans.coord_oracle import CLASSIFY
from keelson.sources.bind import oracle_with

ORACLES: dict[str, str] = {}

ORACLES["stream_current_status"] = oracle_with(["status_events"], """
SELECT project, task_id, status, last_ts, events FROM (
  SELECT project, task_id, status,
    row_number() OVER (PARTITION BY project, task_id ORDER BY ts DESC, event_id DESC) AS r,
    max(ts) OVER (PARTITION BY project, task_id) AS last_ts,
    count(*) OVER (PARTITION BY project, task_id) AS events
  FROM status_events) WHERE r = 1""")

ORACLES["stream_review_requests"] = oracle_with(["messages"], """
SELECT DISTINCT project, thread_id, msg_id, from_agent, ts FROM cm
WHERE thread_kind = 'review' AND msg_kind = 'review_request'""", ctes=[("cm", CLASSIFY)])

ORACLES["stream_agent_sessions"] = oracle_with(["reservations"], """
SELECT agent, session_start, session_end, reservations, ttl_total FROM (
  SELECT agent, min(start_ts) AS session_start, max(start_ts) + INTERVAL 30 MINUTE AS session_end,
         count(*) AS reservations, CAST(sum(ttl_seconds) AS BIGINT) AS ttl_total
  FROM (SELECT *, sum(new) OVER (PARTITION BY agent ORDER BY start_ts, reservation_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
        FROM (SELECT *, CASE WHEN lag(start_ts) OVER (PARTITION BY agent ORDER BY start_ts, reservation_id) IS NULL
                              OR start_ts >= lag(start_ts) OVER (PARTITION BY agent ORDER BY start_ts, reservation_id)
                                            + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new
              FROM reservations))
  GROUP BY agent, sid)
WHERE session_end <= (SELECT max(start_ts) - INTERVAL 1 DAY FROM reservations)""")

ORACLES["stream_message_volume"] = oracle_with(["messages"], """
SELECT project, msg_kind, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS messages
FROM cm GROUP BY ALL""", ctes=[("cm", CLASSIFY)])

ORACLES["stream_message_volume_sliding"] = oracle_with(["messages"], """
SELECT project, msg_kind, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, count(*) AS messages
FROM (SELECT project, msg_kind, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS ws
      FROM cm, (SELECT unnest(range(4)) AS k) o)
GROUP BY ALL""", ctes=[("cm", CLASSIFY)])

ORACLES["stream_review_outcomes"] = oracle_with(["pr_reviews"], """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS reviews, CAST(sum(CASE WHEN upper(state) = 'CHANGES_REQUESTED' THEN 1 ELSE 0 END) AS BIGINT) AS changes_requested
FROM pr_reviews GROUP BY ALL""")

ORACLES["stream_unclaimed_reviews"] = oracle_with(["messages"], """
SELECT r.project, r.thread_id, r.msg_id, r.from_agent, r.ts AS requested_ts FROM cm r
WHERE r.msg_kind = 'review_request'
  AND NOT EXISTS (SELECT 1 FROM cm c WHERE c.msg_kind = 'review_claimed' AND c.project = r.project
                    AND c.thread_id = r.thread_id AND c.ts >= r.ts AND c.ts <= r.ts + INTERVAL 24 HOUR)
  AND r.ts + INTERVAL 24 HOUR < (SELECT least(max(ts) FILTER (WHERE msg_kind = 'review_request'),
                                              max(ts) FILTER (WHERE msg_kind = 'review_claimed')) - INTERVAL 1 HOUR FROM cm)""",
    ctes=[("cm", CLASSIFY)])

ORACLES["stream_review_load"] = oracle_with(["messages"], """
SELECT agent, msg_id, ts, load FROM (
  SELECT from_agent AS agent, msg_id, ts,
    CAST(sum(CASE WHEN msg_kind = 'review_claimed' THEN 1 ELSE -1 END)
         OVER (PARTITION BY from_agent, spell ORDER BY ts, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS load
  FROM (SELECT *, sum(anew) OVER (PARTITION BY from_agent ORDER BY ts, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spell
        FROM (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY from_agent ORDER BY ts, msg_id) + INTERVAL 30 DAY THEN 1 ELSE 0 END AS anew
              FROM cm WHERE msg_kind IN ('review_claimed', 'review_complete'))))
WHERE load > 3 AND ts < (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM cm WHERE msg_kind IN ('review_claimed', 'review_complete'))""",
    ctes=[("cm", CLASSIFY)])

ORACLES["stream_reservation_expiry"] = oracle_with(["reservations"], """
SELECT project, reservation_id, agent, pattern, exclusive, start_ts, start_ts + to_seconds(ttl_seconds) AS expired_ts
FROM reservations
WHERE start_ts + to_seconds(ttl_seconds) < (
    SELECT date_trunc('millisecond', greatest(max(start_ts), max(released_ts))) - INTERVAL 1 DAY FROM reservations)
  AND (released_ts IS NULL OR released_ts >= start_ts + to_seconds(ttl_seconds))""")

ORACLES["stream_check_failures"] = oracle_with(["check_runs"], """
SELECT *, round(failures / runs, 6) AS failure_rate FROM (
  SELECT name, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS runs, CAST(sum(CASE WHEN conclusion IN ('SUCCESS', 'SKIPPED', 'NEUTRAL') THEN 0 ELSE 1 END) AS BIGINT) AS failures
  FROM check_runs WHERE status = 'COMPLETED' GROUP BY ALL)
WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM check_runs)""")
