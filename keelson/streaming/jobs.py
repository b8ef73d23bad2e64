"""Structured Streaming versions of the coordination questions.

Sources are file streams over the fleet tables; the bindings of
``keelson.sources.bind`` apply unchanged to a streaming ``events`` frame
(stateless projections and stream-static joins). Each job has a batch twin
with equal output on a finished input. Append-mode twins (S3, S4, S6, S7) apply
the stream's final watermark; S2, S5 and the review outcomes have no bound in the
twin: rows later than the watermark are dropped by the stream alone. S1 keeps no
state and drops nothing.

``run_stream`` drives a stream to the end of its input (``availableNow``). Given a
stable ``home`` folder, a later run resumes where the last one ended; without one,
each run is its own, in a new folder under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from keelson.functions import expr as X
from keelson.operators import coord as M
from keelson.session import checkpoint_dir
from keelson.sources.bind import Fleet
from keelson.streaming.versions import VersionedTable

WATERMARK = "1 hour"
SESSION_GAP = "30 minutes"


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", max_files: int | None = None) -> DataFrame:
    """File stream over one table of the input folder (new files are new data)."""
    sf_dir = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    r = spark.readStream.schema(schema).option("basePath", sf_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/{table}*.parquet")


def streaming_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    """Fleet whose ``events`` (and every binding built on it) is a stream."""
    return Fleet(spark, sf_dir, overrides={"events": event_stream(spark, sf_dir)})


def run_stream(df: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None,
               home: str | None = None, combine=None) -> DataFrame:
    """Run a streaming frame to the end of its input; return the result table.

    append -> parquet file sink; update -> versioned upsert table by ``keys``
    (``streaming.versions``), whose rows the batch's replace or, with ``combine``, are
    aggregated with. ``home``: folder (on shared storage) that identifies the query;
    a second run with the same one reads only new input.
    """
    spark = df.sparkSession
    base = f"{home.rstrip('/')}/{name}" if home else f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"
    sink, ckpt = f"{base}/out", f"{base}/_checkpoint"
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if mode == "append":
        q = w.outputMode("append").format("parquet").option("path", sink).start()
        q.awaitTermination()
        return spark.read.schema(df.schema).parquet(sink)
    table = VersionedTable(spark, sink, keys or [])
    # with ``combine`` the stream itself keeps no state, so its rows come as they are
    q = (w.outputMode("append" if combine else "update")
         .foreachBatch(lambda batch, batch_id: table.upsert(batch, batch_id, combine)).start())
    q.awaitTermination()
    out = table.read()
    if out is None:                                # no batch ran: the input is empty
        out = spark.createDataFrame([], df.schema)
        return combine(out) if combine else out
    return out if combine else out.select(*df.columns)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession, run):
    """``run()`` with the state store that timers and several states of one key need; a
    query keeps the store it was started with."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return run()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


# ---------------------------------------------------------------- S1..S7 (frame builders; work on batch or stream)

def _event_time(c: str):
    """Event-time column as TIMESTAMP (watermarks need it; the tables store
    wall-clock TIMESTAMP_NTZ, read in the session time zone, UTC)."""
    return F.col(c).cast("timestamp").alias(c)


def current_status(status_events: DataFrame) -> DataFrame:
    """Latest status per task (ties by event id)."""
    return merge_status(status_rows(status_events)).drop("last_event")


def status_rows(status_events: DataFrame) -> DataFrame:
    """S1 as a stream: every event as a table row of its task. The stream keeps no state,
    so no watermark has to bound it and no event is late."""
    return status_events.select("project", "task_id", "status", F.col("ts").alias("last_ts"), F.col("event_id").alias("last_event"),
                                F.lit(1).cast("bigint").alias("events"))


def merge_status(rows: DataFrame) -> DataFrame:
    """One row per task of any number (``status_rows`` or earlier results): the batch's rows
    are combined with the table's, whatever the order in which they come."""
    last = F.struct("last_ts", "last_event")
    return rows.groupBy("project", "task_id").agg(
        F.max_by("status", last).alias("status"), F.max("last_ts").alias("last_ts"), F.max_by("last_event", last).alias("last_event"),
        F.sum("events").alias("events"))


def review_requests(messages: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """Review requests on '*-review' threads, deduplicated on
    (project, thread_id, msg_id)."""
    c = M.classify_messages(messages).filter((F.col("thread_kind") == "review") &
                                             (F.col("msg_kind") == "review_request"))
    c = c.select("project", "thread_id", "msg_id", "from_agent", _event_time("ts"))
    if messages.isStreaming:
        return c.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["project", "thread_id", "msg_id"])
    return c.dropDuplicates(["project", "thread_id", "msg_id"])


def agent_sessions(reservations: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Reservation sessions per agent (activity separated by > gap); what runs out is
    ``reservation_expiry``."""
    r = reservations.withColumn("start_ts", _event_time("start_ts"))
    r = r.withWatermark("start_ts", "1 day") if reservations.isStreaming else r
    s = r.groupBy("agent", F.session_window("start_ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("reservations"), F.sum("ttl_seconds").alias("ttl_total"))
    return s.select("agent", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "reservations", "ttl_total")


def closed_sessions(reservations: DataFrame, gap: str = SESSION_GAP, delay: str = "1 day") -> DataFrame:
    """Batch twin of the append-mode session stream: only sessions that end
    at or before the final watermark (latest start minus the delay) are
    emitted. The bound is a one-row aggregate, broadcast on a constant key."""
    bound = reservations.agg((F.max(_event_time("start_ts")) - F.expr(f"INTERVAL {delay}")).alias("wm")) \
        .withColumn("_k", F.lit(1))
    s = agent_sessions(reservations, gap).withColumn("_k", F.lit(1))
    return (s.join(F.broadcast(bound), "_k").filter(F.col("session_end") <= F.col("wm"))
            .drop("_k", "wm"))


def unclaimed_after(messages: DataFrame, hours: int = 24) -> DataFrame:
    """S3: review requests with no claim within ``hours`` — a stream-stream
    left outer join on the thread with an event-time range condition; the
    unmatched row is emitted once the watermark passes the end of the range."""
    c = M.classify_messages(messages).withColumn("ts", _event_time("ts"))
    req = c.filter(F.col("msg_kind") == "review_request").select(
        "project", "thread_id", "msg_id", "from_agent", F.col("ts").alias("requested_ts"))
    clm = c.filter(F.col("msg_kind") == "review_claimed").select(
        F.col("project").alias("c_project"), F.col("thread_id").alias("c_thread"),
        F.col("ts").alias("claim_ts"), F.col("msg_id").alias("claim_id"))
    if messages.isStreaming:
        req, clm = req.withWatermark("requested_ts", WATERMARK), clm.withWatermark("claim_ts", WATERMARK)
    cond = F.expr(f"c_project = project AND c_thread = thread_id AND claim_ts >= requested_ts "
                  f"AND claim_ts <= requested_ts + INTERVAL {hours} HOURS")
    return (req.join(clm, cond, "leftOuter").filter(F.col("claim_id").isNull())
            .select("project", "thread_id", "msg_id", "from_agent", "requested_ts"))


def unclaimed_after_twin(messages: DataFrame, hours: int = 24) -> DataFrame:
    """Batch twin of S3: the same unmatched requests, limited to those whose
    range has closed before the final watermark (the smaller of the two
    inputs' latest event times, minus the watermark delay)."""
    c = M.classify_messages(messages).withColumn("ts", _event_time("ts"))
    bound = c.agg(F.least(F.max(F.when(F.col("msg_kind") == "review_request", F.col("ts"))),
                          F.max(F.when(F.col("msg_kind") == "review_claimed", F.col("ts"))))
                  .alias("m")).select((F.col("m") - F.expr(f"INTERVAL {WATERMARK}")).alias("wm"), F.lit(1).alias("_k"))
    u = unclaimed_after(messages, hours).withColumn("_k", F.lit(1))
    return (u.join(F.broadcast(bound), "_k")
            .filter(F.col("requested_ts") + F.expr(f"INTERVAL {hours} HOURS") < F.col("wm")).drop("_k", "wm"))


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    # plain objects: a string column of pandas' own kind may come in chunks, which Spark does not take here
    return pd.DataFrame(rows, columns=columns, dtype="object")


class LoadAlarm(StatefulProcessor):
    """S7 per agent: events wait in a list until the watermark has passed them, are then
    taken in event order and added to the agent's load. State: the waiting events (as many as
    the watermark's delay holds), the load unless it is 0, and the time of the last event.
    An agent without an event for ``idle_days`` starts anew, so an idle agent leaves none."""

    def __init__(self, cap: int, idle_days: int):
        self.cap, self.idle = cap, idle_days * 86_400_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ts bigint, msg_id bigint, delta bigint")
        self.load = handle.getValueState("load", "load bigint, last bigint")

    def _wake(self, micros: int) -> None:
        # timers have milliseconds; the next one is after the event's own
        self.handle.registerTimer(micros // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        least, mark = None, timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in rows:
            # what comes after the watermark has passed it is late: its place in the order is gone
            events = [(int(t), int(m), int(d)) for t, m, d in zip(pdf["micros"], pdf["msg_id"], pdf["delta"]) if t >= mark]
            if events:
                self.waiting.appendList(events)
            least = min([e[0] for e in events] + ([least] if least is not None else []), default=None)
        if least is not None:
            self._wake(least)
        yield _frame([], ["agent", "msg_id", "micros", "load"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        load, last = self.load.get() if self.load.exists() else (0, None)
        events = sorted(tuple(int(x) for x in r) for r in self.waiting.get())
        passed = [e for e in events if e[0] < mark]
        left = events[len(passed):]
        out = []
        for ts, msg_id, delta in passed:
            if last is not None and ts > last + self.idle:
                load = 0
            load, last = load + delta, ts
            if load > self.cap:
                out.append((key[0], msg_id, ts, load))
        if left:
            self.waiting.put(left)
            self._wake(left[0][0])
        else:
            self.waiting.clear()
        if load == 0 or (not left and last is not None and last + self.idle < mark):
            self.load.clear()                      # as if it had never been seen
        else:
            self.load.update((load, last))
            if not left:
                self._wake(last + self.idle)
        yield _frame(out, ["agent", "msg_id", "micros", "load"])

    def close(self) -> None:
        pass


IDLE_DAYS = 30


def review_load_alarm(messages: DataFrame, cap: int = 3, idle_days: int = IDLE_DAYS) -> DataFrame:
    """Reviewer load (+1 claim, -1 completion) in event order, whatever the order and
    the files in which events come (within the watermark); emits the events where the load
    exceeds ``cap`` once the watermark has passed them."""
    c = (M.classify_messages(messages).filter(F.col("msg_kind").isin("review_claimed", "review_complete"))
         .select(F.col("from_agent").alias("agent"), "msg_id", _event_time("ts"),
                 F.when(F.col("msg_kind") == "review_claimed", 1).otherwise(-1).cast("bigint").alias("delta"))
         .withWatermark("ts", WATERMARK).withColumn("micros", F.unix_micros("ts")))
    out = c.groupBy("agent").transformWithStateInPandas(
        LoadAlarm(cap, idle_days), "agent string, msg_id bigint, micros bigint, load bigint", "append", "EventTime")
    return out.select("agent", "msg_id", F.timestamp_micros("micros").alias("ts"), "load")


def passed_load_alarms(messages: DataFrame, cap: int = 3, idle_days: int = IDLE_DAYS) -> DataFrame:
    """Batch twin of S7: ``coord.review_load`` up to the final watermark."""
    c = M.classify_messages(messages).filter(F.col("msg_kind").isin("review_claimed", "review_complete"))
    bound = c.agg(_final(F.max(_event_time("ts")), WATERMARK).alias("wm"), F.lit(1).alias("_k"))
    out = M.review_load(messages, cap, idle_days).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("_k", F.lit(1))
    return out.join(F.broadcast(bound), "_k").filter("ts < wm").drop("_k", "wm")


def _final(latest, delay: str):
    """The watermark that a stream ends with: whole milliseconds of the latest event, less the delay."""
    return F.date_trunc("MILLISECOND", latest) - F.expr(f"INTERVAL {delay}")


class ReservationExpiry(StatefulProcessor):
    """S4 per bucket of reservations: all that are held lie in one list, with a timer at the
    earliest end. A call per bucket reads and writes the list at once; a call, a state and a
    timer per reservation took most of the job's time. A release before the end stops a
    reservation; one that comes before its reservation waits for it no longer than until the
    watermark passes the release (a reservation starts before its release, so a later one would
    be late itself)."""

    OUT = ["project", "reservation_id", "agent", "pattern", "exclusive", "start", "end"]

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "project string, reservation_id string, agent string, pattern string, exclusive boolean, "
                                                "start bigint, end bigint, released bigint")

    @staticmethod
    def _due(row) -> int:
        # timers have milliseconds; the next one is after the end (or the release of what was never reserved)
        return (row[6] if row[6] is not None else row[7]) // 1000 + 1

    def _keep(self, rows) -> None:
        if rows:
            self.held.put(rows)
            self.handle.registerTimer(min(map(self._due, rows)))
        elif self.held.exists():
            self.held.clear()

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = {(r[0], r[1]): tuple(r) for r in self.held.get()} if self.held.exists() else {}
        for pdf in rows:
            for kind, project, number, who, what, excl, t, till in zip(*(pdf[c] for c in (
                    "kind", "project", "reservation_id", "agent", "pattern", "exclusive", "micros", "until"))):
                if t < mark:                       # late
                    continue
                _, _, agent, pattern, exclusive, start, end, released = held.get((project, number), (None,) * 8)
                if kind == "release":
                    released = int(t) if released is None else min(released, int(t))
                elif end is None or int(till) > end:                 # a repeated reservation counts with its latest end
                    agent, pattern, exclusive, start, end = who, what, bool(excl), int(t), int(till)
                held[project, number] = (project, number, agent, pattern, exclusive, start, end, released)
        for t in [t for t in self.handle.listTimers()]:
            self.handle.deleteTimer(t)
        # given back in time: nothing expires
        self._keep([r for r in held.values() if not (r[6] is not None and r[7] is not None and r[7] < r[6])])
        yield _frame([], self.OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, rows = timerValues.getCurrentWatermarkInMs(), [tuple(r) for r in self.held.get()]
        self._keep([r for r in rows if self._due(r) > mark])
        yield _frame([r[:7] for r in rows if self._due(r) <= mark and r[6] is not None], self.OUT)

    def close(self) -> None:
        pass


#: lists that open reservations are dealt to; fixed, as a query's state is kept by it
EXPIRY_BUCKETS = 4096
RESERVATION_DELAY = "1 day"


def reservation_expiry(reservation_events: DataFrame) -> DataFrame:
    """One row per reservation that ran out, when the watermark passes start + ttl;
    reservations released before that have none. ``reservation_events`` (kind 'reserve' or
    'release', project, reservation_id, agent, pattern, exclusive, ts, ttl_seconds)."""
    e = (reservation_events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", RESERVATION_DELAY)
         .filter("ts is not null").withColumn("micros", F.unix_micros("ts"))
         .withColumn("until", F.col("micros") + F.coalesce("ttl_seconds", F.lit(0)) * 1_000_000)
         .withColumn("reservation_id", F.col("reservation_id").cast("string"))
         .withColumn("bucket", F.pmod(F.xxhash64("project", "reservation_id"), F.lit(EXPIRY_BUCKETS))))
    out = e.groupBy("bucket").transformWithStateInPandas(
        ReservationExpiry(), "project string, reservation_id string, agent string, pattern string, exclusive boolean, start bigint, end bigint",
        "append", "EventTime")
    return out.select("project", F.col("reservation_id").cast("bigint").alias("reservation_id"), "agent", "pattern", "exclusive",
                      F.timestamp_micros("start").alias("start_ts"), F.timestamp_micros("end").alias("expired_ts"))


def expired_reservations(reservation_events: DataFrame) -> DataFrame:
    """Batch twin of S4: the reservations whose end the final watermark has passed and that
    were not released before it."""
    e = reservation_events.withColumn("ts", F.col("ts").cast("timestamp"))
    bound = e.agg(_final(F.max("ts"), RESERVATION_DELAY).alias("wm"), F.lit(1).alias("_k"))
    end = F.col("ts") + F.make_interval(secs=F.col("ttl_seconds"))
    key = ["project", "reservation_id"]
    r = e.filter("kind = 'reserve'").withColumn("end", end).groupBy(*key).agg(
        F.max_by(F.struct("agent", "pattern", "exclusive", "ts", "end"), "end").alias("r"))
    back = e.filter("kind = 'release'").groupBy(*key).agg(F.min("ts").alias("released"))
    out = r.join(back, key, "left").withColumn("_k", F.lit(1)).join(F.broadcast(bound), "_k")
    return out.filter((F.col("r.end") < F.col("wm")) & (F.col("released").isNull() | (F.col("released") >= F.col("r.end")))).select(
        *key, "r.agent", "r.pattern", "r.exclusive", F.col("r.ts").alias("start_ts"), F.col("r.end").alias("expired_ts"))


def message_volume(messages: DataFrame, slide: str | None = None) -> DataFrame:
    """Messages per (project, kind) in tumbling (or sliding) 1-hour windows."""
    m = M.classify_messages(messages).withColumn("ts", _event_time("ts"))
    m = m.withWatermark("ts", WATERMARK) if messages.isStreaming else m
    win = F.window("ts", "1 hour", slide) if slide else F.window("ts", "1 hour")
    a = m.groupBy("project", "msg_kind", win.alias("w")).agg(F.count(F.lit(1)).alias("messages"))
    return a.select("project", "msg_kind", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "messages")


def review_outcomes_per_hour(reviews: DataFrame) -> DataFrame:
    """Reviews and changes requested per hour (event time), late rows beyond
    the watermark dropped."""
    r = reviews.withColumn("ts", _event_time("ts"))
    r = r.withWatermark("ts", WATERMARK) if reviews.isStreaming else r
    a = r.groupBy(F.window("ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.when(F.upper("state") == "CHANGES_REQUESTED", 1).otherwise(0)).cast("bigint").alias("changes_requested"))
    return a.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "reviews",
                    "changes_requested")


def check_failures_per_hour(runs: DataFrame) -> DataFrame:
    """Finished check runs, failures and failure rate per check name and
    hour (append mode: an hour is emitted once the watermark passes its end)."""
    r = runs.withColumn("ts", _event_time("ts")).withColumn("category", X.check_category(F.col("status"), F.col("conclusion")))
    r = r.withWatermark("ts", WATERMARK) if runs.isStreaming else r
    a = r.filter(F.col("category") != "pending").groupBy("name", F.window("ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("category") == "failing", 1).otherwise(0)).cast("bigint").alias("failures"))
    return a.select("name", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "runs", "failures",
                    F.round(F.col("failures") / F.col("runs"), 6).alias("failure_rate"))


def closed_check_hours(runs: DataFrame) -> DataFrame:
    """Batch twin of S6: the hours that end at or before the final watermark."""
    bound = runs.agg((F.max(_event_time("ts")) - F.expr(f"INTERVAL {WATERMARK}")).alias("wm")).withColumn("_k", F.lit(1))
    a = check_failures_per_hour(runs).withColumn("_k", F.lit(1))
    return a.join(F.broadcast(bound), "_k").filter(F.col("window_end") <= F.col("wm")).drop("_k", "wm")


# ---------------------------------------------------------------- registered stream jobs (run to completion)

def stream_current_status_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(status_rows(f.status_events), "current_status", "update", ["project", "task_id"], combine=merge_status).drop("last_event")


def stream_reservation_expiry_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return with_state_store(spark, lambda: run_stream(reservation_expiry(f.reservation_events), "reservation_expiry", "append"))


def stream_review_requests_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(review_requests(f.messages), "review_requests", "append")


def stream_agent_sessions_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(agent_sessions(f.reservations), "agent_sessions", "append")


def stream_unclaimed_reviews_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(unclaimed_after(f.messages), "unclaimed_reviews", "append")


def stream_review_load_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return with_state_store(spark, lambda: run_stream(review_load_alarm(f.messages, cap=3), "review_load", "append"))


def stream_message_volume_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(message_volume(f.messages), "message_volume", "update",
                      ["project", "msg_kind", "window_start"])


def stream_message_volume_sliding_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(message_volume(f.messages, "15 minutes"), "message_volume_sliding", "update",
                      ["project", "msg_kind", "window_start"])


def stream_review_outcomes_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(review_outcomes_per_hour(f.pr_reviews), "review_outcomes", "update", ["window_start"])


def stream_check_failures_job(spark, sf_dir):
    f = streaming_fleet(spark, sf_dir)
    return run_stream(check_failures_per_hour(f.check_runs), "check_failures", "append")


JOBS = {
    "stream_check_failures": stream_check_failures_job,
    "stream_current_status": stream_current_status_job,
    "stream_review_requests": stream_review_requests_job,
    "stream_agent_sessions": stream_agent_sessions_job,
    "stream_reservation_expiry": stream_reservation_expiry_job,
    "stream_unclaimed_reviews": stream_unclaimed_reviews_job,
    "stream_review_load": stream_review_load_job,
    "stream_message_volume": stream_message_volume_job,
    "stream_message_volume_sliding": stream_message_volume_sliding_job,
    "stream_review_outcomes": stream_review_outcomes_job,
}

# Batch twins (same frame builders on the finished tables).
BATCH_TWINS = {
    "stream_check_failures": lambda spark, d: closed_check_hours(Fleet(spark, d).check_runs),
    "stream_current_status": lambda spark, d: current_status(Fleet(spark, d).status_events),
    "stream_review_requests": lambda spark, d: review_requests(Fleet(spark, d).messages),
    "stream_agent_sessions": lambda spark, d: closed_sessions(Fleet(spark, d).reservations),
    "stream_unclaimed_reviews": lambda spark, d: unclaimed_after_twin(Fleet(spark, d).messages),
    "stream_review_load": lambda spark, d: passed_load_alarms(Fleet(spark, d).messages, cap=3),
    "stream_reservation_expiry": lambda spark, d: expired_reservations(Fleet(spark, d).reservation_events),
    "stream_message_volume": lambda spark, d: message_volume(Fleet(spark, d).messages),
    "stream_message_volume_sliding": lambda spark, d: message_volume(Fleet(spark, d).messages, "15 minutes"),
    "stream_review_outcomes": lambda spark, d: review_outcomes_per_hour(Fleet(spark, d).pr_reviews),
}
