"""Coordination analytics: message threads, review documents, reservations
and agent loops (M1–M20).

Pair-producing questions (reservation conflicts, file hits) are equi-joins on
(project, directory[, time slice]) followed by a theta filter, never a
project-wide cross product. Thread questions are aggregated per thread before
they meet the messages again, so a hot thread never multiplies rows.

Rules marked *ours* are definitions of this library (the protocol documents
name the question, not the formula).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import expr as X
from keelson.operators import globs
from keelson.operators.scan import cut, percentiles, running, settled

# ---------------------------------------------------------------- messages


def classify_messages(messages: DataFrame) -> DataFrame:
    """M4/M5: add thread task id, thread kind and message kind columns."""
    tid, kind = X.thread_kind(F.col("thread_id"))
    return messages.withColumns({"thread_task": tid, "thread_kind": kind,
                                 "msg_kind": X.message_kind(F.col("subject"))})


def inbox(messages: DataFrame, agent: str) -> DataFrame:
    """M1 for one agent: messages not from the agent in threads it takes part
    in or that mention ``@agent``; newest first."""
    part = messages.filter(F.col("from_agent") == agent).select("project", "thread_id").distinct()
    m = messages.filter(F.col("from_agent") != agent)
    in_threads = m.join(part, ["project", "thread_id"], "left_semi")
    mentions = m.filter(F.col("body").rlike(rf"(^|[^A-Za-z0-9_])@{agent}([^A-Za-z0-9_]|$)"))
    return in_threads.unionByName(mentions).distinct().orderBy(F.desc("ts"), F.desc("msg_id"))


MENTION = r"@([A-Za-z][A-Za-z0-9_]*)"


def inbox_summary(messages: DataFrame) -> DataFrame:
    """M1 for every agent at once (*ours*): per (project, agent, thread) the
    number of messages from others and the last time the thread moved.

    Counts come from per-thread and per-(thread, sender) aggregates, so no
    (participant x message) pairs are built; mentions add their own rows.
    """
    thread = messages.groupBy("project", "thread_id").agg(
        F.count(F.lit(1)).alias("n_thread"), F.max("ts").alias("last_ts"))
    own = messages.groupBy("project", "thread_id", F.col("from_agent").alias("agent")).agg(
        F.count(F.lit(1)).alias("n_own"))
    part = (own.join(thread, ["project", "thread_id"])
            .select("project", "agent", "thread_id", (F.col("n_thread") - F.col("n_own")).alias("from_others"),
                    "last_ts"))
    ment = (messages.select("project", "thread_id", "from_agent", "ts",
                            F.explode(F.regexp_extract_all("body", F.lit(MENTION), 1)).alias("agent"))
            .filter(F.col("agent") != F.col("from_agent"))
            .groupBy("project", "agent", "thread_id").agg(F.count(F.lit(1)).alias("mentions")))
    return (part.join(ment, ["project", "agent", "thread_id"], "full")
            .fillna(0, ["from_others", "mentions"])
            .filter((F.col("from_others") > 0) | (F.col("mentions") > 0)))


def thread_messages(messages: DataFrame) -> DataFrame:
    """M2: every message with its position inside its thread (ts, msg_id)."""
    w = Window.partitionBy("project", "thread_id").orderBy("ts", "msg_id")
    return classify_messages(messages).withColumn("pos", F.row_number().over(w).cast("bigint")) \
        .select("project", "thread_id", "pos", "msg_id", "from_agent", "subject", "thread_task",
                "thread_kind", "msg_kind", "ts")


def search_messages(messages: DataFrame, query: str, thread_glob: str = "*") -> DataFrame:
    """M3: case-insensitive text search in subject or body within threads
    matching a glob."""
    q = query.lower()
    hit = F.contains(F.lower("subject"), F.lit(q)) | F.contains(F.lower("body"), F.lit(q))
    return (messages.filter(hit & F.col("thread_id").rlike(_glob_to_regex(thread_glob)))
            .select("project", "thread_id", "msg_id", "from_agent", "subject", "ts"))


def _glob_to_regex(glob: str) -> str:
    out = []
    i = 0
    while i < len(glob):
        c = glob[i]
        if glob.startswith("**", i):
            out.append(".*")
            i += 2
            continue
        out.append({"*": "[^/]*", "?": "[^/]"}.get(c, "\\" + c if not c.isalnum() else c))
        i += 1
    return "^" + "".join(out) + "$"


def escalations(messages: DataFrame) -> DataFrame:
    """Blocked threads and BLOCKED messages per project."""
    c = classify_messages(messages)
    return c.groupBy("project").agg(
        F.countDistinct(F.when(F.col("thread_kind") == "blocked", F.col("thread_id"))).alias("blocked_threads"),
        F.sum(F.when(F.col("msg_kind") == "blocked", 1).otherwise(0)).cast("bigint").alias("blocked_messages"),
        F.sum(F.when(F.col("thread_kind") == "blocked", 1).otherwise(0)).cast("bigint").alias("messages_in_blocked_threads")) \
        .filter((F.col("blocked_threads") > 0) | (F.col("blocked_messages") > 0))


def unclaimed_reviews(messages: DataFrame) -> DataFrame:
    """Review requests with no claim ('Review In Progress') at or after
    the request in the same thread. Claims are reduced to their latest time
    per thread first (one row per thread on the build side)."""
    c = classify_messages(messages)
    req = c.filter(F.col("msg_kind") == "review_request")
    last_claim = (c.filter(F.col("msg_kind") == "review_claimed")
                  .groupBy("project", "thread_id").agg(F.max("ts").alias("last_claim_ts")))
    return (req.join(last_claim, ["project", "thread_id"], "left")
            .filter(F.col("last_claim_ts").isNull() | (F.col("last_claim_ts") < F.col("ts")))
            .select("project", "thread_id", "msg_id", "from_agent", F.col("ts").alias("requested_ts")))


def overdue_reviews(messages: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Review requests not completed within ``hours``: the next
    'Review Complete' at or after the request (as-of join by a forward
    window) is missing at ``as_of`` or came later than the limit."""
    c = classify_messages(messages).filter(F.col("msg_kind").isin("review_request", "review_complete"))
    w = (Window.partitionBy("project", "thread_id").orderBy("ts", F.desc("msg_kind"), "msg_id")
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nxt = F.min(F.when(F.col("msg_kind") == "review_complete", F.col("ts"))).over(w)
    r = c.withColumn("completed_ts", nxt).filter(F.col("msg_kind") == "review_request")
    end = F.coalesce(F.col("completed_ts"), F.lit(as_of).cast("timestamp_ntz"))
    waited = (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(F.col("ts").cast("timestamp"))) / 3600.0
    return (r.withColumn("hours_waiting", F.round(waited, 4))
            .filter(F.col("hours_waiting") > hours)
            .select("project", "thread_id", "msg_id", F.col("ts").alias("requested_ts"), "completed_ts",
                    "hours_waiting"))


def review_load(messages: DataFrame, cap: int = 3, idle_days: int | None = None) -> DataFrame:
    """Reviewer concurrency. +1 at a claim, -1 at a completion, running
    sum per reviewer in time order; rows where the load exceeds ``cap``. With
    ``idle_days``, a reviewer without an event for longer starts anew from 0.
    The sum runs over ranges (``scan.running``), so a reviewer with a third of
    the messages is no single task."""
    c = classify_messages(messages).filter(F.col("msg_kind").isin("review_claimed", "review_complete"))
    delta = F.when(F.col("msg_kind") == "review_claimed", 1).otherwise(-1).cast("bigint")
    c = c.select(F.col("from_agent").alias("agent"), "msg_id", "ts", delta.alias("delta"))
    keys, order = ["agent"], ["ts", "msg_id"]
    if idle_days is not None:
        c = running(c, keys, order, before=("last_before", F.col("ts")))
        anew = F.coalesce((F.col("ts") > F.col("before") + F.make_interval(days=F.lit(idle_days))).cast("bigint"), F.lit(0))
        c = running(c.withColumn("anew", anew), keys, order, spell=("sum", F.col("anew")))
        keys = ["agent", "spell"]
    return running(c, keys, order, load=("sum", F.col("delta"))).filter(F.col("load") > cap).select("agent", "msg_id", "ts", "load")


def task_cycle_time(status_events: DataFrame) -> DataFrame:
    """M20 (*ours*): per task, first in_progress event to the first closed
    event after it, in hours; count, mean, extremes, median and 90th percentile
    by (project, label), project, label and in total (grouping sets)."""
    starts = (status_events.filter(F.col("status") == "in_progress")
              .groupBy("project", "task_id").agg(F.min("ts").alias("start_ts"), F.min("label").alias("label")))
    ends = (status_events.filter(F.col("status") == "closed").select("project", "task_id", "ts").join(starts, ["project", "task_id"])
            .filter(F.col("ts") >= F.col("start_ts"))
            .groupBy("project", "task_id", "label", "start_ts").agg(F.min("ts").alias("end_ts")))
    seconds = F.unix_timestamp(F.col("end_ts").cast("timestamp")) - F.unix_timestamp(F.col("start_ts").cast("timestamp"))
    per = ends.withColumn("seconds", seconds)
    # distinct values with their counts, in each of the four sets: all that is needed from here on
    counts = per.sparkSession.sql("""
        SELECT project, label, CAST(grouping(project) * 2 + grouping(label) AS INT) AS level, seconds, count(*) AS tasks
        FROM {per} GROUP BY GROUPING SETS ((project, label, seconds), (project, seconds), (label, seconds), (seconds))""", per=per)
    counts = cut(counts.withColumn("hours", F.col("seconds") / 3600.0))
    sets = ["project", "label", "level"]
    ranks = percentiles(counts, sets, "hours", "tasks", {"median_hours": 0.5, "p90_hours": 0.9})
    rest = counts.groupBy(*sets).agg((F.sum(F.col("seconds") * F.col("tasks")) / F.sum("tasks") / 3600.0).alias("avg_hours"),
                                     F.min("hours").alias("min_hours"), F.max("hours").alias("max_hours"))
    same = F.col("a.level") == F.col("b.level")
    for c in ("project", "label"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    hours = [F.round(c, 4).alias(c) for c in ("avg_hours", "min_hours", "max_hours", "median_hours", "p90_hours")]
    return ranks.alias("a").join(rest.alias("b"), same).select("a.project", "a.label", "a.level", "tasks", *hours)


# ---------------------------------------------------------------- review documents

SECTION_CATEGORY = {"Blocking Issues": "blocking", "Suggestions": "suggestion", "Questions": "question",
                    "Nitpicks": "nitpick", "Highlights": "praise"}
VERDICT_CHANGES = "Changes Requested"
VERDICT_COMMENTS = "Approved with Comments"
VERDICT_APPROVED = "Approved"


def feedback_items(posts: DataFrame) -> DataFrame:
    """M6/M7: numbered items of review Markdown with their section, category
    and priority. The heading is carried down with ``last(ignorenulls)``."""
    lines = posts.select("project", "thread_id", "msg_id", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    head = F.regexp_extract("line", r"^#{2,3}\s+(.+?)\s*$", 1)
    w = Window.partitionBy("project", "thread_id", "msg_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = lines.withColumn("heading", F.last(F.when(head != "", head), ignorenulls=True).over(w))
    item = r"^\s*(\d+)\.\s+(.*)$"
    items = t.filter(F.col("line").rlike(item)).select(
        "project", "thread_id", "msg_id", F.col("pos").cast("bigint").alias("pos"), "heading",
        F.regexp_extract("line", item, 1).cast("bigint").alias("item_no"),
        F.regexp_extract("line", item, 2).alias("text"))
    cat = X._lookup(F.col("heading"), SECTION_CATEGORY, None)
    return (items.withColumn("category", cat).filter(F.col("category").isNotNull())
            .withColumn("priority", X.feedback_priority(F.col("category"))))


def verdicts(posts: DataFrame, items: DataFrame) -> DataFrame:
    """M8: verdict written in the review and the verdict its items imply."""
    counts = items.groupBy("project", "thread_id", "msg_id").agg(
        F.sum(F.when(F.col("category") == "blocking", 1).otherwise(0)).cast("bigint").alias("blocking"),
        F.sum(F.when(F.col("category").isin("suggestion", "question", "nitpick"), 1).otherwise(0)).cast("bigint")
        .alias("other_items"))
    p = (posts.select("project", "thread_id", "msg_id",
                      F.trim(F.regexp_extract("body", r"\*\*Verdict\*\*:\s*([^\n]+)", 1)).alias("stated"))
         .join(counts, ["project", "thread_id", "msg_id"], "left").fillna(0, ["blocking", "other_items"]))
    derived = (F.when(F.col("blocking") > 0, F.lit(VERDICT_CHANGES))
               .when(F.col("other_items") > 0, F.lit(VERDICT_COMMENTS)).otherwise(F.lit(VERDICT_APPROVED)))
    return p.withColumn("derived", derived).withColumn("consistent", F.col("stated") == F.col("derived"))


def resolutions(posts: DataFrame) -> DataFrame:
    """'- [x] #n' lines of follow-up messages -> (project, thread_id, item_no)."""
    lines = posts.select("project", "thread_id", F.explode(F.split("body", "\n")).alias("line"))
    pat = r"^\s*-\s*\[[xX]\]\s*#(\d+)"
    return (lines.filter(F.col("line").rlike(pat))
            .select("project", "thread_id", F.regexp_extract("line", pat, 1).cast("bigint").alias("item_no")).distinct())


def unresolved_feedback(items: DataFrame, resolved: DataFrame) -> DataFrame:
    """M9: actionable items (not praise) with no resolution line in their thread."""
    return (items.filter(F.col("category") != "praise")
            .join(resolved, ["project", "thread_id", "item_no"], "left_anti"))


# ---------------------------------------------------------------- reservations

def _prefix_dir(pattern: Column) -> Column:
    """Directory part of the literal prefix of a glob ('src/a/**' -> 'src/a',
    '*.md' -> '', the root)."""
    lit = F.regexp_extract(pattern, r"^([^*?]*)", 1)
    return F.regexp_replace(lit, r"/?[^/]*$", "")


def _ancestors(dir_col: Column) -> Column:
    """All ancestor directories of a path, the root ('') and itself included
    ('a/b' -> ['', a, a/b])."""
    parts = F.split(dir_col, "/")
    return F.when(dir_col == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts)),
                    lambda i: F.when(i == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, F.greatest(i, F.lit(1))), "/"))))


def active_reservations(r: DataFrame, as_of) -> DataFrame:
    """Start <= as_of < start + ttl and not released before as_of."""
    t = F.lit(as_of).cast("timestamp_ntz")
    end = F.col("start_ts") + F.make_interval(secs=F.col("ttl_seconds"))
    rel = F.col("released_ts") if "released_ts" in r.columns else F.lit(None).cast("timestamp_ntz")
    return (r.withColumn("end_ts", end)
            .filter((F.col("start_ts") <= t) & (t < F.col("end_ts")) & (rel.isNull() | (rel > t))))


#: Reservations longer than so many usual slices may have slices of their own.
LONG_SLICES = 16
#: No reservation lies in more slices than this.
MOST_SLICES = 100_000
#: Reservations of a pattern that start in a slice are put in lists of about so many.
LIST_ROWS = 1_000


def _slice_widths(rows: DataFrame) -> DataFrame:
    """Per project: the widths (microseconds) of its time slices. The first is twice the
    median length of its reservations; if the long ones would lie in more such slices than
    there are reservations, the second is the mean length of those. So reservations lie in a
    few slices each on average, and a slice holds about as many as are held at a time."""
    length = F.col("s1") - F.col("s0")
    usual = settled(rows.groupBy("project").agg((2 * F.percentile_approx(length, 0.5)).alias("w")))
    far = length > LONG_SLICES * F.col("w")
    of = rows.join(usual, "project").groupBy("project", "w").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(far).alias("n_far"), F.avg(F.when(far, length)).alias("far"), F.max(length).alias("most"))
    split = (F.col("far") * F.col("n_far") > F.col("w").cast("double") * F.col("n")) | (F.col("most") / MOST_SLICES > F.col("w"))
    wide = F.greatest("far", F.col("most") / MOST_SLICES).cast("bigint")
    return settled(of.select("project", F.when(split, F.array("w", wide)).otherwise(F.array("w")).alias("widths")))


def reservation_conflicts(r: DataFrame) -> DataFrame:
    """M11 (*ours*: ``globs.overlap`` decides whether two patterns can name a
    common path, in the sense of ``globs.regex``). Pairs of reservations of
    different agents, at least one exclusive, whose patterns and intervals
    [start, min(start + ttl, release)) overlap.

    Of two intervals that overlap, the later one starts within the other. So a
    reservation is listed as held in the time slices of its project that it touches
    (``_slice_widths``), and as starting in the slice of its start, once for each width. A
    pair meets in one place only: in the slice of the later start, at the directory of the
    outer pattern (an ancestor of the other's, the root included, or the same).

    Patterns are compared once per pair of patterns that meet in a slice, not per pair
    of reservations; then a reservation is listed only under the directories where its
    pattern meets one that fits. What starts in a slice with one pattern is put in lists of bounded
    length, and the patterns are looked up once per list. Pairs are taken from the lists
    as results and are never shuffled, however many there are. Only reservations whose id
    stands on several unlike rows need their pairs made distinct; rows repeated whole count once.
    """
    rel = F.col("released_ts") if "released_ts" in r.columns else F.lit(None).cast("timestamp_ntz")
    end = F.least(F.col("start_ts") + F.make_interval(secs=F.col("ttl_seconds")), rel)
    s0, s1 = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("start_ts", "end_ts"))
    rows = settled(r.withColumn("end_ts", end).filter(F.col("start_ts") < F.col("end_ts"))
                   .select("project", "reservation_id", "agent", "pattern", "exclusive", "start_ts", "end_ts")
                   .repartition("project", "reservation_id").dropDuplicates()
                   .withColumn("again", F.count(F.lit(1)).over(Window.partitionBy("project", "reservation_id")) > 1))
    rows = rows.withColumn("s0", s0).withColumn("s1", F.greatest(s1, F.col("s0") + 1))
    patterns = settled(rows.select("pattern").distinct().withColumn("pid", F.monotonically_increasing_id())
                       .withColumn("dir", _prefix_dir(F.col("pattern"))))
    widths = _slice_widths(rows)
    long = ((F.size("widths") > 1) & (F.col("s1") - F.col("s0") > LONG_SLICES * F.col("widths")[0])).cast("int")

    def held(x):
        x = x.withColumn("l", long).withColumn("w", F.expr("widths[l]"))
        return x.withColumn("slice", F.explode(F.expr("sequence(s0 div w, (s1 - 1) div w)")))

    def starting(x):
        x = x.select("*", F.posexplode("widths").alias("l", "w"))
        return x.withColumn("slice", F.expr("s0 div w"))

    place = ["project", "l", "slice"]
    base = rows.join(patterns.select("pattern", "pid"), "pattern").drop("pattern").join(widths, "project")
    here = settled(held(base).select(*place, "pid", F.lit(0).alias("starts"))
                   .unionByName(starting(base).select(*place, "pid", F.lit(1).alias("starts")))
                   .groupBy(*place, "pid").agg(F.sum("starts").alias("starts")))
    lists = here.groupBy("project").agg(F.ceil(F.max("starts") / LIST_ROWS).alias("lists"))

    at = here.drop("starts").join(patterns.select("pid", "dir"), "pid")
    outer = at.select(*place, F.col("dir").alias("d"), F.col("pid").alias("pid_a"))
    inner = at.select(*place, F.explode(_ancestors(F.col("dir"))).alias("d"), F.col("pid").alias("pid_b"))
    asked = (outer.join(inner, [*place, "d"]).select("pid_a", "pid_b").distinct()
             .join(patterns.select(F.col("pid").alias("pid_a"), F.col("pattern").alias("x"), F.col("dir").alias("d")), "pid_a")
             .join(patterns.select(F.col("pid").alias("pid_b"), F.col("pattern").alias("y")), "pid_b"))
    fit = settled(asked.filter(globs.affixes_agree("x", "y")).filter(globs.overlap_column("x", "y")).select("pid_a", "pid_b", "d"))
    fit = fit.unionByName(fit.select(F.col("pid_b").alias("pid_a"), F.col("pid_a").alias("pid_b"), "d"))
    dirs = settled(fit.groupBy(F.col("pid_a").alias("pid")).agg(F.collect_set("d").alias("dirs"))
                   .join(patterns.select("pid", "dir"), "pid"))
    fit = settled(fit.select("pid_a", "pid_b").distinct())

    def listed(x):
        x = x.join(dirs, "pid").withColumn("d", F.explode("dirs"))
        return x.withColumn("own", F.col("d") == F.col("dir"))

    def pairs(x, y):
        a = listed(held(x)).select(*place, "d", *[F.col(c).alias(f"{c}_a") for c in (
            "reservation_id", "agent", "pid", "exclusive", "start_ts", "end_ts", "own")])
        many = F.pmod(F.xxhash64("reservation_id", "agent", "start_ts", "end_ts"), F.col("lists"))
        group = [*place, "pid", "exclusive", "list"]
        b = (starting(y).join(lists, "project").withColumn("list", many)
             .select(*group, "reservation_id", "agent", "start_ts", "end_ts").repartition(*group)
             .groupBy(*group).agg(F.collect_list(F.struct("reservation_id", "agent", "start_ts", "end_ts")).alias("starts")))
        b = listed(b).select(*place, "d", "starts", *[F.col(c).alias(f"{c}_b") for c in ("pid", "exclusive", "own")])
        j = (a.join(b, [*place, "d"]).filter((F.col("own_a") | F.col("own_b")) & (F.col("exclusive_a") | F.col("exclusive_b")))
             .join(fit, ["pid_a", "pid_b"], "left_semi")
             .select("project", "reservation_id_a", "agent_a", "start_ts_a", "end_ts_a",
                     F.inline("starts").alias("reservation_id_b", "agent_b", "start_ts_b", "end_ts_b")))
        lo = F.col("reservation_id_a") < F.col("reservation_id_b")
        j = j.filter((F.col("start_ts_b") < F.col("end_ts_a")) & (F.col("start_ts_a") <= F.col("start_ts_b"))
                     & (F.col("reservation_id_a") != F.col("reservation_id_b")) & (F.col("agent_a") != F.col("agent_b"))
                     & ((F.col("start_ts_a") < F.col("start_ts_b")) | lo))

        def pick(c, first):
            p, q = (F.col(f"{c}_a"), F.col(f"{c}_b")) if first else (F.col(f"{c}_b"), F.col(f"{c}_a"))
            return F.when(lo, p).otherwise(q)
        return j.select(
            "project", pick("reservation_id", True).alias("res_a"), pick("reservation_id", False).alias("res_b"),
            pick("agent", True).alias("agent_a"), pick("agent", False).alias("agent_b"),
            F.col("start_ts_b").alias("overlap_start"), F.least("end_ts_a", "end_ts_b").alias("overlap_end"))
    again, single = base.filter("again"), base.filter("not again")
    if rows.filter("again").isEmpty():
        return pairs(base, base)
    repeated = pairs(again, base).unionByName(pairs(single, again)).dropDuplicates(["project", "res_a", "res_b"])
    return pairs(single, single).unionByName(repeated)


def file_conflicts(files: DataFrame, active: DataFrame) -> DataFrame:
    """Changed files covered by an active reservation of another agent than
    the one who changed them. Each path is listed under its ancestor directories,
    the root included, and meets reservations on (project, directory); the glob
    is checked afterwards."""
    agent = F.col("agent") if "agent" in files.columns else F.lit(None).cast("string")
    f = (files.select("project", "path", agent.alias("changed_by")).distinct()
         .withColumn("dir", F.explode(_ancestors(F.regexp_replace("path", r"/?[^/]*$", "")))))
    r = active.select("project", _prefix_dir(F.col("pattern")).alias("dir"), "reservation_id", "agent",
                      "pattern", "exclusive")
    return (f.join(r, ["project", "dir"])
            .filter(~F.col("agent").eqNullSafe(F.col("changed_by")) & F.regexp_like(F.col("path"), globs.regex(F.col("pattern"))))
            .select("project", "path", "changed_by", "reservation_id", "agent", "pattern", "exclusive"))


# ---------------------------------------------------------------- agent loops

def loop_iterations(commits: DataFrame) -> DataFrame:
    """Checkpoint commits 'ralph: iteration N - text' per project with
    gaps and repeats against the previous checkpoint."""
    n = F.regexp_extract("subject", X.LOOP_COMMIT_PATTERN, 1)
    c = (commits.filter(F.col("subject").rlike(X.LOOP_COMMIT_PATTERN))
         .select("project", n.cast("bigint").alias("iteration"),
                 F.regexp_extract("subject", X.LOOP_COMMIT_PATTERN, 2).alias("summary"), "seq"))
    c = running(c, ["project"], ["seq"], prev_iteration=("last_before", F.col("iteration")))
    issue = (F.when(F.col("prev_iteration").isNull(), F.lit(None))
             .when(F.col("iteration") == F.col("prev_iteration"), F.lit("repeat"))
             .when(F.col("iteration") > F.col("prev_iteration") + 1, F.lit("gap"))
             .when(F.col("iteration") < F.col("prev_iteration"), F.lit("backwards")))
    return c.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def loop_completion(runs: DataFrame, max_iterations: int = 30) -> DataFrame:
    """A run completes only when tests pass (exit 0) AND the output holds
    the completion promise. Per project: first completing iteration, runs
    until then, and whether the limit was passed before completing."""
    done = (F.col("exit_code") == 0) & F.contains(F.col("output"), F.lit(X.COMPLETION_PROMISE))
    a = runs.groupBy("project").agg(
        F.min(F.when(done, F.col("iteration"))).alias("completed_at"),
        F.count(F.lit(1)).alias("iterations"),
        F.sum(F.when(F.contains(F.col("output"), F.lit(X.COMPLETION_PROMISE)) & (F.col("exit_code") != 0), 1)
              .otherwise(0)).cast("bigint").alias("promise_without_tests"))
    return a.withColumn("over_limit", F.coalesce(F.col("completed_at"), F.col("iterations")) > max_iterations) \
        .withColumn("completed", F.col("completed_at").isNotNull())


# ---------------------------------------------------------------- delivery policy

def delivery_check(messages: DataFrame, policies: DataFrame, contacts: DataFrame) -> DataFrame:
    """May a message reach its recipient (the previous sender in the
    thread)? open -> yes; auto -> yes (same thread); contacts_only -> only
    when the sender is an approved contact of the recipient; block_all -> no.
    Agents without a policy are treated as auto."""
    w = Window.partitionBy("project", "thread_id").orderBy("ts", "msg_id")
    m = (messages.select("project", "thread_id", "msg_id", "from_agent", "ts",
                         F.lag("from_agent").over(w).alias("recipient"))
         .filter(F.col("recipient").isNotNull() & (F.col("recipient") != F.col("from_agent"))))
    c = contacts.select(F.col("agent").alias("recipient"), F.col("contact").alias("from_agent"),
                        F.lit(True).alias("is_contact")).distinct()
    p = policies.select(F.col("agent").alias("recipient"), "contact_policy")
    j = m.join(p, "recipient", "left").join(c, ["recipient", "from_agent"], "left")
    pol = F.coalesce(F.col("contact_policy"), F.lit("auto"))
    allowed = (F.when(pol == "open", True).when(pol == "auto", True)
               .when(pol == "contacts_only", F.coalesce(F.col("is_contact"), F.lit(False)))
               .otherwise(False))
    return j.select("project", "thread_id", "msg_id", "from_agent", "recipient", pol.alias("policy"),
                    allowed.alias("allowed"))
