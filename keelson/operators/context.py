"""Working-context analytics: the git and task state of every checkout.

Inputs are snapshot tables collected elsewhere (porcelain lines, commits,
file changes, stash lines, tracking headers, tracker text); every operator is
a join / aggregate over them keyed by ``project``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import expr as X
from keelson.operators.scan import ranked, settled

# Fixed values (text of the source's attention items and headings).
STASH_ITEM = "⚠️ {n} stashed change(s) - consider applying or dropping"
BEHIND_ITEM = "⚠️ Branch is {info} - consider pulling"
AHEAD_ITEM = "📤 Branch is {info} - remember to push"
INBOX_ITEM = "💬 Check inbox for messages in {task}-review thread"


def _fmt(template: str, **cols: Column) -> Column:
    """Fill a '{name}' template with column values (concat of pieces)."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if pre:
            pieces.append(F.lit(pre))
        pieces.append(cols[name].cast("string"))
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


# ---------------------------------------------------------------- W1..W4

def current_task(checkouts: DataFrame, list_lines: DataFrame, show_blocks: DataFrame) -> DataFrame:
    """Current task of each checkout (project, branch).

    First in-progress task from the tracker listing (order: listing seq),
    else the id in the branch name with title/status looked up from the
    tracker's show text; without a match only the branch id.
    """
    lid, ltitle = X.parse_list_line(F.col("line"))
    inprog = (list_lines.filter(F.col("status") == "in_progress")
              .select("project", "seq", lid.alias("lid"), ltitle.alias("ltitle"))
              .filter(F.col("lid") != "")
              .groupBy("project")
              .agg(F.min_by(F.struct("lid", "ltitle"), F.col("seq")).alias("first")))
    show = show_blocks.select("project", F.col("task_id").alias("bid"),
                              X.show_field(F.col("block"), "Title").alias("stitle"),
                              X.show_field(F.col("block"), "Status").alias("sstatus"))
    c = (checkouts.select("project", "branch")
         .withColumn("bid", X.extract_task_id(F.col("branch")))
         .join(inprog, "project", "left")
         .join(show, ["project", "bid"], "left"))
    return c.select(
        "project", "branch",
        F.coalesce(F.col("first.lid"), F.col("bid")).alias("task_id"),
        F.coalesce(F.col("first.ltitle"), F.col("stitle"), F.lit("")).alias("title"),
        F.when(F.col("first.lid").isNotNull(), F.lit("in_progress"))
         .otherwise(F.coalesce(F.col("sstatus"), F.lit(""))).alias("status"),
        F.when(F.col("first.lid").isNotNull(), F.lit("in_progress_list"))
         .when(F.col("bid") != "", F.lit("branch")).otherwise(F.lit("none")).alias("source"))


# ---------------------------------------------------------------- W5, W6, W9, W10, W21

def status_counts(porcelain: DataFrame) -> DataFrame:
    """Staged / modified / untracked per project from XY codes (XY is
    a fixed two-character column) and the summary text."""
    x = F.substring("xy", 1, 1)
    y = F.substring("xy", 2, 1)
    c = porcelain.filter(F.length("xy") >= 2).groupBy("project").agg(
        F.sum(F.when(x == "?", 1).otherwise(0)).cast("bigint").alias("untracked"),
        F.sum(F.when((x != "?") & (x != " "), 1).otherwise(0)).cast("bigint").alias("staged"),
        F.sum(F.when((y != " ") & (y != "?"), 1).otherwise(0)).cast("bigint").alias("modified"))
    return c.withColumn("status_text", X.format_status(F.col("staged"), F.col("modified"), F.col("untracked")))


def remote_status(header: Column) -> tuple[Column, Column, Column]:
    """(ahead, behind, info) from a tracking header '## a...b [ahead n, behind m]'."""
    info = F.regexp_extract(header, r"\[([^\]]+)\]", 1)
    ahead = F.coalesce(F.regexp_extract(info, r"ahead (\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    behind = F.coalesce(F.regexp_extract(info, r"behind (\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return ahead, behind, info


def worktree_summary(checkouts: DataFrame, porcelain: DataFrame, stashes: DataFrame,
                     current: DataFrame) -> DataFrame:
    """W5, W6, W9, W10, W21 per checkout: counts, status text, stash count,
    ahead/behind and the ordered list of attention items."""
    counts = status_counts(porcelain)
    stash = stashes.groupBy("project").agg(F.count(F.lit(1)).cast("bigint").alias("stash_count"))
    ahead, behind, info = remote_status(F.col("header"))
    c = (checkouts.select("project", "branch", ahead.alias("ahead"), behind.alias("behind"), info.alias("info"))
         .join(counts, "project", "left").join(stash, "project", "left")
         .join(current.select("project", "branch", "task_id"), ["project", "branch"], "left")
         .fillna(0, ["staged", "modified", "untracked", "stash_count"])
         .fillna("", ["status_text"]))
    items = F.array_compact(F.array(
        F.when(F.col("stash_count") > 0, _fmt(STASH_ITEM, n=F.col("stash_count"))),
        F.when(F.col("behind") > 0, _fmt(BEHIND_ITEM, info=F.col("info")))
         .when(F.col("ahead") > 0, _fmt(AHEAD_ITEM, info=F.col("info"))),
        F.when(F.coalesce(F.col("task_id"), F.lit("")) != "", _fmt(INBOX_ITEM, task=F.col("task_id")))))
    return c.select("project", "branch", "staged", "modified", "untracked", "status_text",
                    "stash_count", "ahead", "behind", items.alias("pending_items"))


# ---------------------------------------------------------------- W7, W8, W23

def _among(commits: DataFrame, wanted: DataFrame, c: str) -> DataFrame:
    """``commits`` whose (project, ``c``) is in ``wanted``. Asked by ``c`` alone first: where
    commits are put together from several tables, the optimizer takes that down to the one that
    ``c`` comes from, so that what is not wanted is neither joined nor grouped."""
    return (commits.join(wanted.select(c), c, "left_semi")
            .join(wanted.select("project", c), ["project", c], "left_semi"))


def of_branches(rows: DataFrame, checkouts: DataFrame) -> DataFrame:
    """The rows (project, branch, ...) of checked-out branches."""
    return _among(rows, settled(checkouts.select("project", "branch")), "branch")


def branch_commits(commits: DataFrame, checkouts: DataFrame, k: int = 5) -> DataFrame:
    """Commits of the checked-out branch that are not on the base branch;
    when there are none, the latest k commits of the branch instead. Commits are
    gone through twice, for those of the branches and for those of the base among
    them; what is left is written and read from there on."""
    c = settled(of_branches(commits, checkouts))
    base = _among(commits, c, "sha").filter("on_base").select("project", "sha").distinct()
    ahead = settled(c.join(base, ["project", "sha"], "left_anti"))
    has_ahead = ahead.select("project", "branch").distinct()
    w = Window.partitionBy("project", "branch").orderBy(F.desc("ts"), F.desc("sha"))
    recent = (c.join(has_ahead, ["project", "branch"], "left_anti")
              .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r"))
    cols = ["project", "branch", "sha", "subject", "ts"]
    return (ahead.select(*cols).withColumn("kind", F.lit("ahead_of_base"))
            .unionByName(recent.select(*cols).withColumn("kind", F.lit("recent"))))


def relative_age(ts: Column, as_of: Column) -> Column:
    """Relative age text with git's %ar rounding steps (seconds .. years)."""
    s = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))
    m = F.floor((s + 30) / 60)
    h = F.floor((m + 30) / 60)
    d = F.floor((h + 12) / 24)
    tm = F.floor((d * 24 + 365) / 730)  # total months for the 1..5 year range

    def unit(n, name):
        n = n.cast("bigint")
        return F.concat(n.cast("string"), F.lit(" " + name), F.when(n == 1, F.lit("")).otherwise(F.lit("s")))

    ago = F.lit(" ago")
    return (F.when(s < 0, F.lit("in the future"))
            .when(s < 90, F.concat(unit(s, "second"), ago))
            .when(m < 90, F.concat(unit(m, "minute"), ago))
            .when(h < 36, F.concat(unit(h, "hour"), ago))
            .when(d < 14, F.concat(unit(d, "day"), ago))
            .when(d < 70, F.concat(unit(F.floor((d + 3) / 7), "week"), ago))
            .when(d < 365, F.concat(unit(F.floor((d + 15) / 30), "month"), ago))
            .when((d < 1825) & (tm % 12 != 0),
                  F.concat(unit(F.floor(tm / 12), "year"), F.lit(", "), unit(tm % 12, "month"), ago))
            .when(d < 1825, F.concat(unit(F.floor(tm / 12), "year"), ago))
            .otherwise(F.concat(unit(F.floor((d + 183) / 365), "year"), ago)))


def recent_commit(commits: DataFrame, checkouts: DataFrame, as_of) -> DataFrame:
    """Latest commit of the checked-out branch of every project with
    '<subject> (<age>)'."""
    last = (commits.join(checkouts.select("project", "branch"), ["project", "branch"])
            .groupBy("project", "branch")
            .agg(F.max_by(F.struct("subject", "sha", "ts"), F.struct("ts", "sha")).alias("c")))
    age = relative_age(F.col("c.ts"), F.lit(as_of))
    return last.select("project", "branch", F.col("c.sha").alias("sha"), F.col("c.subject").alias("subject"),
                       F.col("c.ts").alias("ts"), age.alias("age"),
                       F.concat(F.col("c.subject"), F.lit(" ("), age, F.lit(")")).alias("summary"))


COMMIT_REF_PATTERNS = [r"^(bd-\d+):", r"^\[([A-Za-z0-9._-]+)\]", r"(?m)^Bead: (bd-\d+)\s*$"]

# what a subject that fits the pattern starts with or holds
COMMIT_REF_SIGNS = [lambda c: c.startswith("bd-"), lambda c: c.startswith("["), lambda c: c.contains("Bead: bd-")]


def commit_task_links(commits: DataFrame, tasks: DataFrame) -> DataFrame:
    """Commits whose message names a task (`bd-N: …`, `[id] …`,
    trailer `Bead: bd-N`), joined to that task."""
    # a pattern is tried where its fixed text occurs; each is evaluated once, as explode drops commits without a task
    found = [F.when(may(F.col("subject")), F.regexp_extract("subject", p, 1)) for p, may in zip(COMMIT_REF_PATTERNS, COMMIT_REF_SIGNS)]
    ref = F.explode(F.slice(F.filter(F.array(*found), lambda x: x != ""), 1, 1))
    c = commits.select("project", "branch", "sha", "subject", ref.alias("task_id"))
    return c.join(tasks.select("project", "task_id", "status", F.col("title").alias("task_title")),
                  ["project", "task_id"], "left") \
        .withColumn("task_found", F.col("status").isNotNull())


# ---------------------------------------------------------------- W12..W14, hot files

def base_branch(base_branches: DataFrame, projects: DataFrame) -> DataFrame:
    """Main if it exists, else master if it exists, else main."""
    flags = base_branches.groupBy("project").agg(
        F.bool_or(F.col("name") == "main").alias("has_main"),
        F.bool_or(F.col("name") == "master").alias("has_master"))
    return (projects.select("project").distinct().join(flags, "project", "left")
            .select("project", F.when(F.col("has_main"), F.lit("main"))
                    .when(F.col("has_master"), F.lit("master")).otherwise(F.lit("main")).alias("base_branch")))


def branch_diff_stats(file_changes: DataFrame, base: DataFrame) -> DataFrame:
    """Files changed / insertions / deletions of each branch against its
    base (changes of commits not on the base branch) and the summary line."""
    d = file_changes.filter(~F.col("on_base"))
    s = d.groupBy("project", "branch").agg(
        F.countDistinct("path").alias("files"),
        F.sum("insertions").cast("bigint").alias("insertions"),
        F.sum("deletions").cast("bigint").alias("deletions"),
        F.countDistinct("sha").alias("commits"))
    s = s.join(base, "project", "left")
    summary = F.concat(F.col("files").cast("string"),
                       F.when(F.col("files") == 1, F.lit(" file changed")).otherwise(F.lit(" files changed")),
                       F.lit(", "), F.col("insertions").cast("string"), F.lit(" insertions(+), "),
                       F.col("deletions").cast("string"), F.lit(" deletions(-)"))
    return s.withColumn("summary", summary)


def files_changed(file_changes: DataFrame) -> DataFrame:
    """Last change letter per (branch, path) against the base."""
    d = file_changes.filter(~F.col("on_base"))
    return (d.groupBy("project", "branch", "path")
            .agg(F.max_by("change_type", F.struct("ts", "sha", "change_type")).alias("change_type"))
            .withColumn("line", F.concat(F.col("change_type"), F.lit("\t"), F.col("path"))))


def hot_files(file_changes: DataFrame, k: int = 10) -> DataFrame:
    """Top-k paths per project touched by the most branches (a top-k report)."""
    c = (file_changes.groupBy("project", "path").agg(F.countDistinct("branch").alias("branches"),
                                                     F.sum(F.col("insertions") + F.col("deletions")).cast("bigint").alias("churn")))
    w = Window.partitionBy("project").orderBy(F.desc("branches"), F.desc("churn"), "path")
    return c.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def changed_files(file_changes: DataFrame, suffix: str = ".py", kind: str = "M") -> DataFrame:
    """Distinct paths of a change kind with a suffix, per branch."""
    return (file_changes.filter((F.col("change_type") == kind) & F.col("path").endswith(suffix))
            .select("project", "branch", "path").distinct())


# ---------------------------------------------------------------- W11, W16, W18, W19

def log_digest(logs: DataFrame, max_lines: int = 50) -> DataFrame:
    """Failed tool runs with output, headed by tool, line count
    of the whole output and the head excerpt (cut at ``max_lines``)."""
    heading = X._lookup(F.col("tool"), X.ERROR_HEADINGS, F.concat(F.col("tool"), F.lit(":")))
    f = logs.filter((F.col("exit_code") != 0) & (F.col("output") != ""))
    keep = [c for c in ("project",) if c in logs.columns]
    return f.select("log_id", *keep, "tool", heading.alias("heading"),
                    X.count_lines(F.col("output")).alias("n_lines"),
                    F.concat(heading, F.lit("\n"), X.truncate_lines(F.col("output"), max_lines)).alias("excerpt"))


def error_digest(logs: DataFrame, max_lines: int = 50) -> DataFrame:
    """Per project, all failed tool runs with output, each under its
    heading, joined by a blank line in tool order and cut once, after joining, to
    ``max_lines`` lines. Only a project's first ``max_lines`` runs can reach the
    text (each has two lines at least); the line count covers all of them."""
    heading = X._lookup(F.col("tool"), X.ERROR_HEADINGS, F.concat(F.col("tool"), F.lit(":")))
    order = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(t) for t in X.ERROR_HEADINGS]), F.col("tool")), F.lit(0)),
                       F.lit(len(X.ERROR_HEADINGS) + 1))
    f = logs.filter((F.col("exit_code") != 0) & (F.col("output") != "")).select(
        "project", "log_id", order.alias("place"), heading.alias("heading"), "output",
        F.size(F.split("output", "\n")).alias("lines"))
    totals = f.groupBy("project").agg(F.count(F.lit(1)).alias("failed_runs"),
                                      (F.sum(F.col("lines") + 2) - 1).alias("n_lines"))
    w = Window.partitionBy("project").orderBy("place", "log_id")
    first = (f.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= max_lines)
             .withColumn("text", F.concat("heading", F.lit("\n"), F.array_join(F.slice(F.split("output", "\n"), 1, max_lines), "\n")))
             .groupBy("project").agg(F.array_sort(F.collect_list(F.struct("r", "text", "lines"))).alias("runs")))
    # a run of more lines than fit ends the text anyway
    text = F.array_join(F.transform("runs", lambda x: x["text"]), "\n\n")
    shown = F.array_join(F.slice(F.split(text, "\n"), 1, max_lines), "\n")
    return totals.join(first, "project").select(
        "project", "failed_runs", "n_lines",
        F.when(F.col("n_lines") <= max_lines, text).otherwise(
            F.concat(shown, F.lit("\n... ("), (F.col("n_lines") - max_lines).cast("string"), F.lit(" more lines)"))).alias("errors"))


# marker file -> command, in precedence order (fixed values)
TEST_COMMANDS = [
    ("go.mod", "go test ./... && go build ./..."),
    ("package.json", None),
    ("pyproject.toml", "pytest"),
    ("setup.py", "pytest"),
    ("Cargo.toml", "cargo test && cargo build"),
    ("Makefile", "make test"),
]


def detect_test_command(repo_files: DataFrame) -> DataFrame:
    """Test command per repository from root-level marker files."""
    root = repo_files.filter(~F.col("path").contains("/"))
    names = ["go.mod", "package.json", "yarn.lock", "pnpm-lock.yaml", "pyproject.toml", "setup.py",
             "Cargo.toml", "Makefile"]
    flags = root.groupBy("project").agg(*[F.bool_or(F.col("path") == n).alias(n) for n in names])
    node = (F.when(F.col("`yarn.lock`"), F.lit("yarn test"))
            .when(F.col("`pnpm-lock.yaml`"), F.lit("pnpm test")).otherwise(F.lit("npm test")))
    cmd = None
    for marker, text in TEST_COMMANDS:
        val = node if text is None else F.lit(text)
        cond = F.col(f"`{marker}`")
        cmd = F.when(cond, val) if cmd is None else cmd.when(cond, val)
    cmd = cmd.otherwise(F.lit(X.NO_TEST_RUNNER))
    return flags.select("project", cmd.alias("test_command"))


# ---------------------------------------------------------------- W24, W25 context tables

def context_next(current: DataFrame, counts: DataFrame, recent: DataFrame, top: DataFrame, nxt: DataFrame) -> DataFrame:
    """W24 'next': per checkout — current task, working-tree text, latest commit
    and the recommended task: the first of the triage (``top``) with its score and
    reason, else the first ready task. All inputs are one row per project (or per
    checkout), so the joins never fan out."""
    first = top.filter("rank_in_project = 1").select("project", F.col("task_id").alias("top_task"), "score", "reason")
    ready = nxt.select("project", F.col("task_id").alias("ready_task"))
    out = (current.select("project", "branch", "task_id", "title")
           .join(counts.select("project", "status_text"), "project", "left")
           .join(recent.select("project", "branch", F.col("summary").alias("recent_commit")), ["project", "branch"], "left")
           .join(first, "project", "left").join(ready, "project", "left"))
    return out.select("project", "branch", "task_id", "title", F.coalesce("status_text", F.lit("")).alias("status_text"), "recent_commit",
                      F.coalesce("top_task", "ready_task").alias("recommended_task"),
                      F.when(F.col("top_task").isNotNull(), F.lit("triage")).when(F.col("ready_task").isNotNull(), F.lit("ready")).alias("recommended_by"),
                      "score", "reason")


def context_commits(branch_rows: DataFrame) -> DataFrame:
    """The commits that done, resume, feedback, stuck and pr list, newest first,
    one row per line ('<short sha> <first line of the message>')."""
    line = F.concat(F.substring("sha", 1, 7), F.lit(" "), F.split("subject", "\n")[0])
    return ranked(branch_rows, ["project", "branch"], [F.desc("ts"), F.desc("sha")], "pos").select("project", "branch", "pos", "kind", line.alias("line"))


def context_pr_files(checkouts: DataFrame, changed: DataFrame) -> DataFrame:
    """W24 'pr': the changed files of every checked-out branch, one row per line."""
    return changed.join(checkouts.select("project", "branch"), ["project", "branch"], "left_semi").select("project", "branch", "path", "line")


def _open_prs(checkouts: DataFrame, open_pr: DataFrame) -> DataFrame:
    return checkouts.select("project", "branch").join(
        open_pr.select("project", F.col("head_ref").alias("branch"), "number"), ["project", "branch"])


def context_prfix_checks(checkouts: DataFrame, open_pr: DataFrame, details: DataFrame) -> DataFrame:
    """W24 'pr-fix': failing and pending checks (name, URL) of every checkout's PR."""
    return _open_prs(checkouts, open_pr).join(details.select("project", "number", "category", "seq", "name", "line"), ["project", "number"])


def context_prfix_reviews(checkouts: DataFrame, open_pr: DataFrame, reviews: DataFrame) -> DataFrame:
    """W24 'pr-fix': the reviews of every checkout's PR with their state, one line each."""
    mark = X.review_state_mark(F.col("state"))
    line = F.concat(F.lit("- "), mark, F.lit(" **"), "author", F.lit("**: "), "state")
    return _open_prs(checkouts, open_pr).join(reviews.select("project", "number", "seq", "author", "state"), ["project", "number"]).withColumn("line", line)


def context_prfix_comments(checkouts: DataFrame, open_pr: DataFrame, comments: DataFrame) -> DataFrame:
    """W24 'pr-fix': the quoted review comments of every checkout's PR."""
    text = F.concat(F.lit("**@"), "author", F.lit("** on `"), "location", F.lit("`:\n"), "quoted")
    return _open_prs(checkouts, open_pr).join(
        comments.select("project", "number", "author", "location", "quoted"), ["project", "number"]).withColumn("text", text)


def context_feedback(current: DataFrame, base: DataFrame, diff: DataFrame, counts: DataFrame,
                     branch_rows: DataFrame) -> DataFrame:
    """W24 'feedback': current task and its review thread (W22), working-tree
    text, base branch (W12), diff summary of the checked-out branch (W13) and the
    number of its commits."""
    return (current.select("project", "branch", "task_id", "title")
            .withColumn("review_thread", X.review_thread(F.col("task_id")))
            .join(base, "project", "left")
            .join(counts.select("project", "status_text"), "project", "left")
            .join(diff.select("project", "branch", "files", "insertions", "deletions", "summary"),
                  ["project", "branch"], "left")
            .join(_commit_counts(branch_rows), ["project", "branch"], "left")
            .fillna(0, ["commits_on_branch"]).fillna("", ["status_text"]))


def context_loop(checkouts: DataFrame, modes: DataFrame, ready: DataFrame, nxt: DataFrame,
                 test_cmd: DataFrame) -> DataFrame:
    """W24 'loop' + W25, one row per checkout: objective mode (goal text >
    autopilot > single task), the goal, the task of a single-task loop with a
    shell-safe title (W20; none if nothing is ready), the number of ready tasks
    and the test command (W19). ``modes(project, goal, autopilot)``; the tasks
    an autopilot loop walks are ``autopilot_tasks``."""
    counts = ready.groupBy("project").agg(F.count(F.lit(1)).alias("ready_tasks"))
    goal = F.coalesce("goal", F.lit(""))
    mode = (F.when(goal != "", F.lit("goal")).when(F.coalesce("autopilot", F.lit(False)), F.lit("autopilot"))
            .otherwise(F.lit("single")))
    return (checkouts.select("project", "branch").join(modes, "project", "left").withColumn("mode", mode)
            .join(nxt.select("project", "task_id", X.sanitize(F.col("title")).alias("safe_title")), "project", "left")
            .join(counts, "project", "left").join(test_cmd, "project", "left")
            .select("project", "branch", "mode", F.when(F.col("mode") == "goal", F.col("goal")).alias("goal"),
                    F.when(F.col("mode") == "single", F.col("task_id")).alias("task_id"),
                    F.when(F.col("mode") == "single", F.col("safe_title")).alias("safe_title"),
                    F.coalesce("ready_tasks", F.lit(0)).cast("bigint").alias("ready_tasks"),
                    F.coalesce("test_command", F.lit(X.NO_TEST_RUNNER)).alias("test_command"),
                    F.lit(X.COMPLETION_PROMISE).alias("completion_promise")))


def autopilot_tasks(modes: DataFrame, ready: DataFrame) -> DataFrame:
    """The ready tasks of every autopilot loop in the order it takes them
    (priority, seq, task_id), one row per task."""
    on = modes.filter((F.coalesce("goal", F.lit("")) == "") & F.col("autopilot")).select("project")
    ready = ready.join(on, "project", "left_semi")
    return ranked(ready, ["project"], ["priority", "seq", "task_id"], "pos").select(
        "project", "pos", "task_id", X.sanitize(F.col("title")).alias("safe_title"), "priority")


STAT_WIDTH = 60        # signs of a --stat line at most


def diff_stat(hunks: DataFrame) -> DataFrame:
    """Per project, side ('staged', 'unstaged') and path the changed lines and the line that
    ``git diff --stat`` prints (one sign per line, in proportion beyond ``STAT_WIDTH``)."""
    sides = hunks.withColumn("side", F.explode(F.array_compact(F.array(F.when(F.col("staged"), F.lit("staged")), F.when(F.col("unstaged"), F.lit("unstaged"))))))
    s = sides.groupBy("project", "side", "path").agg(F.sum("insertions").alias("insertions"), F.sum("deletions").alias("deletions"))
    total = F.col("insertions") + F.col("deletions")
    plus = F.when(total <= STAT_WIDTH, F.col("insertions")).otherwise(F.floor(F.col("insertions") * STAT_WIDTH / total)).cast("int")
    minus = F.when(total <= STAT_WIDTH, F.col("deletions")).otherwise(F.floor(F.col("deletions") * STAT_WIDTH / total)).cast("int")
    line = F.concat(F.lit(" "), "path", F.lit(" | "), total.cast("string"), F.lit(" "), F.repeat(F.lit("+"), plus), F.repeat(F.lit("-"), minus))
    return s.withColumn("line", line)


def _stat_summary() -> Column:
    def some(n, one, many):
        return F.concat(F.col(n).cast("string"), F.when(F.col(n) == 1, F.lit(one)).otherwise(F.lit(many)))
    return F.concat(F.lit(" "), F.concat_ws(
        ", ", some("files", " file changed", " files changed"),
        F.when(F.col("insertions") > 0, some("insertions", " insertion(+)", " insertions(+)")),
        F.when(F.col("deletions") > 0, some("deletions", " deletion(-)", " deletions(-)"))))


def diff_sections(hunks: DataFrame, max_lines: int = 100) -> DataFrame:
    """W15 (+W16): per project, the ``--stat`` of the staged changes under 'Staged:', of the
    unstaged ones under 'Unstaged:' and the diff itself (a head per file, its hunks in order),
    joined by a blank line (empty parts skipped) and cut once, after joining, to ``max_lines``
    lines. No part can show more lines than that, so each is reduced by a partial top-k
    before the shuffle (every file has a line, every hunk two); the count of lines left out
    covers all. ``hunks(project, path, staged, unstaged, hunk_no, insertions, deletions, hunk)``."""
    def first(rows, order, line):
        w = Window.partitionBy("project").orderBy(*order)
        return (rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_lines)
                .groupBy("project").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", line.alias("l")))), lambda x: x["l"]), "\n").alias("l")))
    stat, parts = diff_stat(hunks), None
    for side in ("staged", "unstaged"):
        r = stat.filter(F.col("side") == side)
        sums = r.groupBy("project").agg(F.count(F.lit(1)).alias("files"), F.sum("insertions").alias("insertions"), F.sum("deletions").alias("deletions"))
        part = sums.join(first(r, ["path"], F.col("line")).withColumnRenamed("l", "lines"), "project").select(
            "project", F.col("files").alias(f"n_{side}"), F.concat(F.lit(f"{side.title()}:\n"), "lines", F.lit("\n"), _stat_summary()).alias(f"l_{side}"))
        parts = part if parts is None else parts.join(part, "project", "full")
    # the first hunk of a file carries the file's head
    file = Window.partitionBy("project", "path").orderBy("hunk_no")
    head = F.concat(F.lit("diff --git a/"), "path", F.lit(" b/"), "path", F.lit("\n--- a/"), "path", F.lit("\n+++ b/"), "path", F.lit("\n"))
    top = hunks.withColumn("_r", F.row_number().over(file)).filter(F.col("_r") <= max_lines).select(
        "project", "path", "hunk_no", F.when(F.col("_r") == 1, F.concat(head, "hunk")).otherwise(F.col("hunk")).alias("text"))
    lines = hunks.groupBy("project", "path").agg(F.sum(F.size(F.split("hunk", "\n"))).alias("k")).groupBy("project").agg((F.sum("k") + 3 * F.count(F.lit(1))).alias("n_content"))
    parts = parts.join(lines.join(first(top, ["path", "hunk_no"], F.col("text")).withColumnRenamed("l", "l_content"), "project"), "project", "full")
    s = parts.fillna(0, ["n_staged", "n_unstaged", "n_content"])
    text = F.concat_ws("\n\n", "l_staged", "l_unstaged", "l_content")
    some = [F.when(F.col(f"n_{k}") > 0, F.lit(extra) + F.col(f"n_{k}")).otherwise(F.lit(0)) for k, extra in (("staged", 3), ("unstaged", 3), ("content", 1))]
    total = some[0] + some[1] + some[2] - 1        # titles, summaries and a blank line between parts
    shown = F.array_join(F.slice(F.split(text, "\n"), 1, max_lines), "\n")
    return s.select("project", "n_staged", "n_unstaged", total.cast("bigint").alias("n_lines"),
                    F.when(total <= max_lines, text).otherwise(
                        F.concat(shown, F.lit("\n... ("), (total - max_lines).cast("string"), F.lit(" more lines)"))).alias("diff"))


def _commit_counts(branch_rows: DataFrame) -> DataFrame:
    return branch_rows.groupBy("project", "branch").agg(F.count(F.lit(1)).alias("commits_on_branch"))


def context_done(current: DataFrame, branch_rows: DataFrame, counts: DataFrame) -> DataFrame:
    """W24 'done': task, commits on the branch, working-tree text."""
    return (current.select("project", "branch", "task_id", "title", "status")
            .join(_commit_counts(branch_rows), ["project", "branch"], "left")
            .join(counts.select("project", "status_text"), "project", "left")
            .fillna(0, ["commits_on_branch"]).fillna("", ["status_text"]))


def context_resume(current: DataFrame, worktree: DataFrame, branch_rows: DataFrame) -> DataFrame:
    """W24 'resume': task, uncommitted work, commits and attention items."""
    return (current.select("project", "branch", "task_id", "title", "status")
            .join(worktree.select("project", "branch", "status_text", "pending_items"), ["project", "branch"], "left")
            .join(_commit_counts(branch_rows), ["project", "branch"], "left")
            .fillna(0, ["commits_on_branch"]))


def context_pr(current: DataFrame, base: DataFrame, open_pr: DataFrame, branch_rows: DataFrame,
               diff: DataFrame, changed: DataFrame, counts: DataFrame) -> DataFrame:
    """W24 'pr': base branch, existing PR, commits, diff summary, files
    changed and working-tree text of every checkout; the lists are
    ``context_commits`` and ``context_pr_files``."""
    files = changed.groupBy("project", "branch").agg(F.count(F.lit(1)).alias("files_changed"))
    return (current.select("project", "branch", "task_id", "title")
            .join(base, "project", "left")
            .join(open_pr.select("project", F.col("head_ref").alias("branch"), F.col("number").alias("pr_number"), F.col("title").alias("pr_title"),
                                 F.col("state").alias("pr_state"), F.col("url").alias("pr_url")), ["project", "branch"], "left")
            .join(_commit_counts(branch_rows), ["project", "branch"], "left")
            .join(diff.select("project", "branch", F.col("summary").alias("diff_summary")), ["project", "branch"], "left")
            .join(files, ["project", "branch"], "left")
            .join(counts.select("project", "status_text"), "project", "left")
            .fillna(0, ["commits_on_branch", "files_changed"]).fillna("", ["status_text"]))


def context_prfix(current: DataFrame, open_pr: DataFrame, check_counts: DataFrame, issues: DataFrame,
                  review_counts: DataFrame) -> DataFrame:
    """W24 'pr-fix': the open PR of each checkout (title, URL, state, base) with the
    current task, check counts, review count, mergeable label, ordered issues and
    merge readiness; checkouts without a PR keep a row with ``has_pr`` false. The
    lists are ``context_prfix_checks``, ``_reviews`` and ``_comments``."""
    pr = open_pr.select("project", F.col("head_ref").alias("branch"), "number", F.col("title").alias("pr_title"), F.col("url").alias("pr_url"),
                        F.col("state").alias("pr_state"), "base_ref")
    return (current.select("project", "branch", "task_id", "title").join(pr, ["project", "branch"], "left")
            .join(check_counts.select("project", "number", "passing", "failing", "pending"), ["project", "number"], "left")
            .join(review_counts.select("project", "number", "reviews"), ["project", "number"], "left")
            .join(issues.select("project", "number", "mergeable_label", "issues", "merge_ready"), ["project", "number"], "left")
            .withColumn("has_pr", F.col("number").isNotNull())
            .fillna(0, ["passing", "failing", "pending", "reviews"]))


def context_stuck(current: DataFrame, counts: DataFrame, sections: DataFrame, branch_rows: DataFrame,
                  errors: DataFrame) -> DataFrame:
    """W24 'stuck': task, working-tree text, diff sections, commits and the
    error digest of the project (``error_digest``)."""
    return (current.select("project", "branch", "task_id", "title")
            .join(counts.select("project", "status_text"), "project", "left")
            .join(sections.select("project", "diff"), "project", "left")
            .join(_commit_counts(branch_rows), ["project", "branch"], "left")
            .join(errors.select("project", "failed_runs", "errors"), "project", "left")
            .fillna(0, ["commits_on_branch", "failed_runs"]).fillna("", ["status_text", "diff", "errors"]))
