"""Task-graph analytics over (tasks, deps) edge lists, for all projects at once.

``tasks(project, task_id, title, status, priority, label, seq)`` and
``deps(project, child, parent)`` (child waits for parent). ``project`` is part
of every key, so a single loop serves the whole fleet, and a huge project is
still spread over many tasks because rows hash on (project, task_id).

Iterative jobs are frontier loops (most of them in ``operators.paths``): only
nodes that changed in a round send messages in the next one; every round cuts
lineage with a reliable ``checkpoint()`` into the session's checkpoint folder, and
only counts reach the driver. Loops run until nothing changes; no round limit can
end one with a partial result.

Formulas marked *ours* are definitions fixed by this library (the source only
names the question).
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators import paths as P
from keelson.operators.scan import cut as _cut
from keelson.operators.scan import cut_round, ranked, settled

KEY = ["project", "task_id"]


def not_closed(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("status") != "closed")


def open_edges(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Edges whose child and parent are both known, not-closed tasks."""
    nodes = not_closed(tasks).select("project", "task_id")
    return (deps.select("project", "child", "parent")
            .join(nodes.withColumnRenamed("task_id", "child"), ["project", "child"], "left_semi")
            .join(nodes.withColumnRenamed("task_id", "parent"), ["project", "parent"], "left_semi"))


# ---------------------------------------------------------------- G1 .. G4

def ready_tasks(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """G1: open tasks none of whose known parents is still not closed.

    A parent id that is not a task (dangling edge) does not block.
    """
    blockers = not_closed(tasks).select("project", F.col("task_id").alias("parent"))
    blocked = (deps.select("project", "child", "parent")
               .join(blockers, ["project", "parent"], "left_semi")
               .select("project", F.col("child").alias("task_id")))
    return (tasks.filter(F.col("status") == "open")
            .join(blocked, KEY, "left_anti")
            .select("project", "task_id", "title", "priority", "label", "seq"))


def next_tasks(ready: DataFrame, k: int = 1) -> DataFrame:
    """Top-k ready tasks per project by (priority, seq, task_id).

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    shuffle, so a hot project sends at most k rows per map task.
    """
    w = Window.partitionBy("project").orderBy("priority", "seq", "task_id")
    return (ready.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= k))


def blocked_tasks(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Not-closed tasks with their open blockers, one row per blocker.

    ``n_blockers`` comes from a partially aggregated count joined back, so a
    task with a huge in-degree is never gathered into one list.
    """
    nc = not_closed(tasks)
    pairs = (deps.select("project", "child", "parent")
             .join(nc.select("project", F.col("task_id").alias("parent"),
                             F.col("status").alias("blocker_status")), ["project", "parent"])
             .join(nc.select("project", F.col("task_id").alias("child"), "status", "priority"),
                   ["project", "child"]))
    counts = pairs.groupBy("project", "child").agg(F.count(F.lit(1)).alias("n_blockers"))
    return (pairs.join(counts, ["project", "child"])
            .select("project", F.col("child").alias("task_id"), "status", "priority",
                    F.col("parent").alias("blocked_by"), "blocker_status", "n_blockers"))


def newly_unblocked(tasks: DataFrame, deps: DataFrame, closing: DataFrame) -> DataFrame:
    """Tasks that become ready once the tasks in ``closing`` are closed.

    Ready-after minus ready-before, restricted to children of a closed task.
    """
    closing = closing.select("project", "task_id").distinct()
    after_tasks = (tasks.join(closing.withColumn("_c", F.lit(True)), KEY, "left")
                   .withColumn("status", F.when(F.col("_c"), F.lit("closed")).otherwise(F.col("status")))
                   .drop("_c"))
    before = ready_tasks(tasks, deps).select(*KEY)
    children = (deps.join(closing.withColumnRenamed("task_id", "parent"), ["project", "parent"], "left_semi")
                .select("project", F.col("child").alias("task_id")))
    return (ready_tasks(after_tasks, deps)
            .join(before, KEY, "left_anti")
            .join(children, KEY, "left_semi"))


# ---------------------------------------------------------------- G5 .. G7

STATUSES = ["open", "in_progress", "closed"]


def status_counts(tasks: DataFrame) -> DataFrame:
    """Task count per status per project (fixed pivot list: no extra job)."""
    p = tasks.groupBy("project").pivot("status", STATUSES).agg(F.count(F.lit(1)))
    return (p.select("project", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in STATUSES])
            .withColumn("total", F.col("open") + F.col("in_progress") + F.col("closed")))


def progress_report(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Per (project, label) with rollup totals: completed count and share,
    in progress, blocked (not closed with an open blocker), ready."""
    blocked = (blocked_tasks(tasks, deps).select(*KEY).distinct().withColumn("is_blocked", F.lit(1)))
    ready = ready_tasks(tasks, deps).select(*KEY).withColumn("is_ready", F.lit(1))
    t = (tasks.select("project", "task_id", "label", "status")
         .join(blocked, KEY, "left").join(ready, KEY, "left"))
    agg = t.rollup("project", "label").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("status") == "closed", 1).otherwise(0)).cast("bigint").alias("completed"),
        F.sum(F.when(F.col("status") == "in_progress", 1).otherwise(0)).cast("bigint").alias("in_progress"),
        F.sum(F.coalesce(F.col("is_blocked"), F.lit(0))).cast("bigint").alias("blocked"),
        F.sum(F.coalesce(F.col("is_ready"), F.lit(0))).cast("bigint").alias("ready"),
    )
    return agg.withColumn("pct_complete", F.round(F.col("completed").cast("double") * 100 / F.col("total"), 2))


def priority_distribution(tasks: DataFrame) -> DataFrame:
    """Tasks per (project, priority) and share within the project."""
    c = tasks.groupBy("project", "priority").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("project")  # at most four rows per project after the aggregate
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(w), 6))


# ---------------------------------------------------------------- G17 cycles

def cycle_members(deps: DataFrame, method: str = "words") -> DataFrame:
    """Tasks that lie on a dependency cycle.

    ``method="words"`` (default, ``paths.cycle_ids``): runs of tasks become one
    node, what is on no cycle is peeled off, and what is left is on a cycle if its
    own bit comes back when the tasks' bits are sent along the edges; no pairs are
    held. ``method="coloring"`` finds strongly connected components of what is
    left by forward/backward colouring (``_scc_members``) with O(1) state per
    task, for very large cycles of many branches.
    """
    ids = P.numbered(P.nodes_of(deps))
    e = P.edge_ids(ids, deps)
    if method == "coloring":
        core = (P.peel(e).join(ids.select("project", F.col("task_id").alias("child"), F.col("id").alias("c")), "c")
                .join(ids.select(F.col("task_id").alias("parent"), F.col("id").alias("p")), "p"))
        return _scc_members(core.select("project", "child", "parent"))
    return ids.join(P.cycle_ids(ids, e), "id", "left_semi").select(*KEY)


def _propagate_min(label: DataFrame, edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Frontier loop: label(dst) = min(label(dst), label(src)) along edges
    (project, src, dst) until nothing changes. ``label(project, node, l)``."""
    label = _cut(label)
    frontier = label
    while True:
        msg = (frontier.select("project", F.col("node").alias(src), "l").join(edges, ["project", src])
               .filter(F.col("l").isNotNull())
               .groupBy("project", F.col(dst).alias("node")).agg(F.min("l").alias("nl")))
        upd = _cut(msg.join(label, ["project", "node"])
                   .filter(F.col("l").isNull() | (F.col("nl") < F.col("l")))
                   .select("project", "node", F.col("nl").alias("l")))
        if upd.isEmpty():
            break
        label = _cut(label.join(upd.select("project", "node"), ["project", "node"], "left_anti").unionByName(upd))
        frontier = upd
    return label


def _scc_members(e: DataFrame) -> DataFrame:
    """Tasks in a strongly connected component of more than one task (or
    with a self edge), by forward/backward colouring — no node pairs:
    colour = smallest id that reaches a task; each colour's root collects,
    backwards within its colour, the tasks that reach it (its component);
    found components are removed and the rest coloured again."""
    e = _cut(e.select("project", "child", "parent").distinct())
    selfloop = e.filter(F.col("child") == F.col("parent")).select("project", F.col("child").alias("task_id"))
    e = _cut(e.filter(F.col("child") != F.col("parent")))
    nodes = _cut(e.select("project", F.col("child").alias("node"))
                 .unionByName(e.select("project", F.col("parent").alias("node"))).distinct())
    found = selfloop
    while True:
        if nodes.isEmpty():
            break
        # colour: smallest id among tasks that reach this one (child reaches parent)
        col = _propagate_min(nodes.withColumn("l", F.col("node")), e, "child", "parent")
        col = _cut(col.withColumnRenamed("l", "c"))
        same = (e.join(col.select("project", F.col("node").alias("child"), F.col("c").alias("cc")), ["project", "child"])
                .join(col.select("project", F.col("node").alias("parent"), F.col("c").alias("cp")), ["project", "parent"])
                .filter(F.col("cc") == F.col("cp")).select("project", "child", "parent"))
        # back from each root (colour == own id) over same-colour edges: who reaches the root
        start = col.select("project", "node", F.when(F.col("c") == F.col("node"), F.col("node")).alias("l"))
        back = _propagate_min(start, same, "parent", "child")
        comp = _cut(back.filter(F.col("l").isNotNull()).select("project", "node", F.col("l").alias("root")))
        big = comp.groupBy("project", "root").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        found = found.unionByName(comp.join(big, ["project", "root"], "left_semi")
                                  .select("project", F.col("node").alias("task_id")))
        nodes = _cut(nodes.join(comp.select("project", "node"), ["project", "node"], "left_anti"))
        e = _cut(e.join(comp.select("project", F.col("node").alias("child")), ["project", "child"], "left_anti")
                 .join(comp.select("project", F.col("node").alias("parent")), ["project", "parent"], "left_anti"))
    return _cut(found.distinct())


# ---------------------------------------------------------------- levels

def task_levels(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Level of every not-closed task: 1 for a task without open parents,
    else 1 + max(level of open parents). Cycle members are left out, and so are
    the edges from them. Returns (project, task_id, level).

    ``paths.levels`` levels an acyclic graph and proves it acyclic; long chains
    take rounds in the log of their length. Only when tasks remain (cycles and
    what depends on them) does cycle detection run, on that remainder alone.
    """
    ids, _, lv = _leveled(tasks, deps)
    return ids.join(lv, "id").select(*KEY, "level")


def _leveled(tasks: DataFrame, deps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``task_levels`` in numbers: the not-closed tasks (project, task_id, id), the edges
    (c, p) between them, and (id, level)."""
    ids = P.numbered(not_closed(tasks))
    e = P.edge_ids(ids, deps)
    lv = P.levels(ids, e)
    rest = ids.select("id").join(lv, "id", "left_anti")
    if not rest.isEmpty():
        keep = _cut(ids.select("id").join(P.cycle_ids(ids, _within(e, rest)), "id", "left_anti"))
        lv = P.levels(keep, _cut(_within(e, keep)))
    return ids, e, lv


def _within(e: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges between ``nodes`` (id)."""
    return (e.join(nodes.select(F.col("id").alias("c")), "c", "left_semi")
            .join(nodes.select(F.col("id").alias("p")), "p", "left_semi").select("c", "p"))


def _with_pred(level: DataFrame, deps_open: DataFrame) -> DataFrame:
    """Add ``pred``: the smallest-id open parent exactly one level up (the
    previous task on a longest chain); null for level-1 tasks."""
    p = (deps_open.join(level.select("project", F.col("task_id").alias("parent"),
                                     F.col("level").alias("plevel")), ["project", "parent"])
         .join(level.select("project", F.col("task_id").alias("child"), "level"), ["project", "child"])
         .filter(F.col("plevel") == F.col("level") - 1)
         .groupBy("project", F.col("child").alias("task_id"))
         .agg(F.min("parent").alias("pred")))
    return level.join(p, KEY, "left")


def graph_tree(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Every not-closed task with its depth from the roots and its open parents."""
    ids, e, lv = _leveled(tasks, deps)
    parents = (e.join(ids.select(F.col("id").alias("p"), F.col("task_id").alias("parent")), "p").groupBy(F.col("c").alias("id"))
               .agg(F.array_sort(F.collect_set("parent")).alias("parents")))
    return (ids.join(lv, "id").join(parents, "id", "left")
            .select(*KEY, "level", F.coalesce(F.col("parents"), F.array().cast("array<string>")).alias("parents"))
            .withColumn("n_parents", F.size("parents").cast("bigint")))


def critical_path(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """G9 (*ours*: unit weights): the longest chain of not-closed tasks per
    project, ordered from its root (pos 1). End node: highest level, ties by
    smallest task_id; each step back takes the smallest-id parent one level up.

    The chain is read off the predecessor forest with jump tables (pointer
    doubling): table k maps a task to its ancestor 2^k steps back. Building
    and expanding take about 2*log2(depth) rounds over the tasks, instead of
    one scan of all tasks per step of the longest chain.
    """
    lv = _cut(_with_pred(task_levels(tasks, deps), open_edges(tasks, deps)))
    w = Window.partitionBy("project").orderBy(F.desc("level"), "task_id")
    ends = _cut(lv.withColumn("r", F.row_number().over(w)).filter("r = 1")
                .select("project", "task_id", F.col("level").alias("length")))
    depth = lv.agg(F.max("level")).first()[0] or 0   # one bounded number reaches the driver
    jumps = [_cut(lv.filter(F.col("pred").isNotNull()).select(*KEY, F.col("pred").alias("j")))]
    while (1 << len(jumps)) < depth:
        prev = jumps[-1]
        jumps.append(_cut(prev.join(prev.select("project", F.col("task_id").alias("j"), F.col("j").alias("jj")),
                                    ["project", "j"]).select(*KEY, F.col("jj").alias("j"))))
    chain = ends.select("project", "task_id", "length")
    for jt in reversed(jumps):
        step = chain.join(jt, KEY).select("project", F.col("j").alias("task_id"), "length")
        chain = _cut(chain.unionByName(step))
    return chain.join(lv.select(*KEY, "level"), KEY).select("project", F.col("level").alias("pos"), "task_id", "length")


def weak_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id of every node's weakly connected component (``paths.components``;
    a smaller number is a smaller id). ``nodes(project, task_id)``, ``edges(project, a, b)``
    (either direction)."""
    ids = P.numbered(nodes.filter(F.col("project").isNotNull() & F.col("task_id").isNotNull()))
    e = P.edge_ids(ids, edges.select("project", F.col("a").alias("child"), F.col("b").alias("parent")))
    return _named(ids, P.components(ids, e)).select(*KEY, "label")


def _named(ids: DataFrame, least: DataFrame) -> DataFrame:
    """``least(id, least, ...)`` with the tasks' names and, as ``label``, the name of the smallest."""
    return least.join(ids, "id").join(ids.select(F.col("id").alias("least"), F.col("task_id").alias("label")), "least")


def parallel_tracks(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """G8 (*ours*): level and track of every not-closed, non-cyclic task.

    track = smallest task_id of the weakly connected component of the open
    graph (``weak_components``).
    """
    ids, e, lv = _leveled(tasks, deps)
    ids = ids.filter(F.col("project").isNotNull() & F.col("task_id").isNotNull())
    comp = P.components(lv.select("id"), _within(e, lv))
    return _named(ids, comp.join(lv, "id")).select(*KEY, "level", F.col("label").alias("track"))


# ---------------------------------------------------------------- G10, G11

def _reach(e: DataFrame, first: DataFrame) -> DataFrame:
    """Transitive closure of the pairs ``first`` (project, task_id, dependent)
    along the edges ``e``; a node never counts itself."""
    reach = _cut(first)
    frontier = reach
    nxt_edges = e.select("project", F.col("parent").alias("dependent"), F.col("child").alias("nxt"))
    for r in itertools.count(1):
        step = (frontier.join(nxt_edges, ["project", "dependent"])
                .select("project", "task_id", F.col("nxt").alias("dependent")).distinct())
        new = _cut(step.join(reach, ["project", "task_id", "dependent"], "left_anti"))
        if new.isEmpty():
            break
        reach = reach.unionByName(new)             # a union of cut frames, itself cut now and then
        if r % 6 == 0:
            reach = _cut(reach)
        frontier = new
    return reach.filter(F.col("task_id") != F.col("dependent"))


def descendants(tasks: DataFrame, deps: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Transitive open dependents: (project, task_id, dependent) pairs over the
    open graph (cycle members included; a node never counts itself), of all
    tasks or only of those in ``sources`` (project, task_id)."""
    e = _cut(open_edges(tasks, deps).distinct())
    first = e.select("project", F.col("parent").alias("task_id"), F.col("child").alias("dependent"))
    return _reach(e, first if sources is None else first.join(sources.select(*KEY).distinct(), KEY, "left_semi"))


def dependent_counts(tasks: DataFrame, deps: DataFrame, sources: DataFrame | None = None,
                     max_words: int = P.MAX_WORDS) -> DataFrame:
    """Number of transitive open dependents per task that has any (project,
    task_id, transitive_dependents), exact, of all tasks or those in ``sources``.
    No pairs: dependents are bits, 64 tasks to a row, and at most ``max_words``
    rows are held in one pass over a block of them (``paths.dependent_totals``);
    the result does not depend on it."""
    ids = P.numbered(not_closed(tasks))
    counts = P.dependent_totals(ids, P.edge_ids(ids, deps), max_words)
    out = ids.join(counts, "id").select(*KEY, F.col("n").alias("transitive_dependents"))
    return out if sources is None else out.join(sources.select(*KEY).distinct(), KEY, "left_semi")


def dependent_counts_sketch(tasks: DataFrame, deps: DataFrame, lg_k: int = 12) -> DataFrame:
    """Approximate number of transitive open dependents per task, for graphs
    where the exact (task, dependent) pairs would be too many.

    On a cycle a task counts itself, too.

    Each task holds an HLL sketch of its dependents, the union over its
    children of (child id + child's sketch); only tasks whose sketch changed
    send it on in the next round. State is one fixed-size sketch per task
    (small sets are held exactly in the sketch's list mode), so the work per
    round grows with the edges, not with the square of chain length.
    """
    e = _cut(open_edges(tasks, deps).distinct())
    own = e.groupBy("project", F.col("parent").alias("task_id")).agg(
        F.hll_sketch_agg("child", lg_k).alias("own"))
    sk = _cut(own.select(*KEY, F.col("own").alias("s")))
    own = _cut(own)
    frontier = sk
    while True:
        msg = (frontier.select("project", F.col("task_id").alias("child"), "s")
               .join(e, ["project", "child"])
               .groupBy("project", F.col("parent").alias("task_id")).agg(F.hll_union_agg("s").alias("m")))
        upd = (msg.join(sk, KEY).join(own, KEY)
               .select(*KEY, F.hll_union(F.hll_union("s", "m"), "own").alias("ns"), "s")
               .filter(F.col("ns") != F.col("s")))
        upd = _cut(upd.select(*KEY, F.col("ns").alias("s")))
        if upd.isEmpty():
            break
        sk = _cut(sk.join(upd.select(*KEY), KEY, "left_anti").unionByName(upd))
        frontier = upd
    return sk.select(*KEY, F.hll_sketch_estimate("s").alias("transitive_dependents"))


def blockers_to_clear(tasks: DataFrame, deps: DataFrame, method: str = "exact") -> DataFrame:
    """Not-closed tasks with direct and transitive open dependents,
    ranked per project (most transitive dependents first, then task_id).
    ``method="sketch"`` counts transitive dependents with HLL sketches
    (``dependent_counts_sketch``) instead of exactly. Ranks are found in ranges,
    so a project with a third of the tasks is no single task."""
    direct = (open_edges(tasks, deps).groupBy("project", F.col("parent").alias("task_id"))
              .agg(F.countDistinct("child").alias("direct_dependents")))
    if method == "sketch":
        trans = dependent_counts_sketch(tasks, deps)
    else:
        trans = dependent_counts(tasks, deps)
    out = (not_closed(tasks).select(*KEY, "status", "priority")
           .join(direct, KEY, "left").join(trans, KEY, "left")
           .fillna(0, ["direct_dependents", "transitive_dependents"])
           .filter(F.col("transitive_dependents") > 0))
    return ranked(out, ["project"], [F.desc("transitive_dependents"), F.asc("task_id")])


def pagerank(tasks: DataFrame, deps: DataFrame, d: float = 0.85, iters: int = 20) -> DataFrame:
    """G11 (*ours*): PageRank per project over all tasks, edge child -> parent
    (rank flows to what others depend on). Dangling mass is spread evenly
    inside the project; fixed iteration count; ranks sum to 1 per project.

    Spreading mass evenly is linear, so the loop only pushes the even start
    vector along the edges, ``v[j+1] = d * P' v[j]``: one join of co-partitioned
    frames and one aggregation per round, without a join on the project. The
    rank after ``iters`` rounds is ``v[iters] + sum(s[iters-1-j] * v[j])``; as
    ranks sum to 1, the spread ``s[k]`` follows from the vectors' sums per
    project, which meet the vectors once at the end.
    """
    ids = P.numbered(tasks.filter(F.col("project").isNotNull()))
    n = ids.groupBy("project").agg(F.count(F.lit(1)).cast("double").alias("n"))
    e = P.edge_ids(ids, deps)
    share = e.groupBy("c").agg((F.lit(d) / F.count(F.lit(1))).alias("share"))
    e = settled(e.join(share, "c"))
    v = settled(ids.join(n, "project").select("id", (F.lit(1.0) / F.col("n")).alias("v")))
    vectors = v.withColumn("j", F.lit(0))
    for j in range(1, iters + 1):
        v = cut_round(e.join(v.withColumnRenamed("id", "c"), "c")
                      .groupBy(F.col("p").alias("id")).agg(F.sum(F.col("v") * F.col("share")).alias("v")), j)
        if v.isEmpty():                            # no way is longer: all later vectors are empty too
            break
        vectors = vectors.unionByName(v.withColumn("j", F.lit(j)))
    # a task's vectors side by side, one entry per round
    at = (vectors.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("m"))
          .select("id", F.expr(f"transform(sequence(0, {iters}), j -> coalesce(m[j], 0D))").alias("v")))
    at = settled(ids.join(at, "id").select(*KEY, "v"))
    sums = at.groupBy("project").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(iters + 1)]).alias("sums"))
    spread = F.expr(f"""aggregate(sequence(0, {iters - 1}), cast(array() as array<double>), (s, k) -> concat(s, array(
        1 - sums[k + 1] - if(k = 0, 0D, aggregate(sequence(0, greatest(k - 1, 0)), 0D, (a, j) -> a + s[k - 1 - j] * sums[j + 1])))))""")
    weight = sums.select("project", spread.alias("s")).select("project", F.expr("concat(reverse(s), array(1D))").alias("w"))
    return at.join(weight, "project").select(*KEY, F.expr("aggregate(zip_with(v, w, (a, b) -> a * b), 0D, (a, b) -> a + b)").alias("rank"))


# ---------------------------------------------------------------- G12 .. G15, G18

def triage(tasks: DataFrame, deps: DataFrame, k: int = 5) -> DataFrame:
    """G12 (*ours*): ready tasks ranked by
    0.4*transitive/max + 0.3*pagerank/max + 0.3*(3-priority)/3, top k."""
    # read once: ready tasks, dependents and ranks all use both
    tasks, deps = settled(tasks.select(*KEY, "title", "status", "priority", "label", "seq")), settled(deps.select("project", "child", "parent"))
    ready = ready_tasks(tasks, deps).select(*KEY, "priority", "seq")
    trans = dependent_counts(tasks, deps, ready).select(*KEY, F.col("transitive_dependents").cast("double").alias("unblocks"))
    pr = pagerank(tasks, deps)
    t = ready.join(trans, KEY, "left").join(pr, KEY).fillna(0.0, ["unblocks"])
    # per-project maxima as a partial aggregate joined back (a hot project is
    # reduced map-side instead of being gathered into one window task)
    mx = t.groupBy("project").agg(F.max("unblocks").alias("max_u"), F.max("rank").alias("max_r"))
    t = (t.join(mx, "project")
         .withColumn("t_unblock", F.when(F.col("max_u") > 0, 0.4 * F.col("unblocks") / F.col("max_u")).otherwise(0.0))
         .withColumn("t_rank", F.when(F.col("max_r") > 0, 0.3 * F.col("rank") / F.col("max_r")).otherwise(0.0))
         .withColumn("t_prio", 0.3 * (3 - F.col("priority")) / 3.0)
         .withColumn("score", F.round(F.col("t_unblock") + F.col("t_rank") + F.col("t_prio"), 6))
         .withColumn("reason",
                     F.when((F.col("t_unblock") >= F.col("t_rank")) & (F.col("t_unblock") >= F.col("t_prio")),
                            F.lit("unblocks the most work"))
                     .when(F.col("t_rank") >= F.col("t_prio"), F.lit("central in the dependency graph"))
                     .otherwise(F.lit("high priority"))))
    wr = Window.partitionBy("project").orderBy(F.desc("score"), "priority", "seq", "task_id")
    return (t.withColumn("rank_in_project", F.row_number().over(wr).cast("bigint"))
            .filter(F.col("rank_in_project") <= k)
            .select("project", "task_id", "priority", F.col("unblocks").cast("bigint").alias("unblocks"),
                    "score", "reason", "rank_in_project"))


def quick_wins(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """G13 (*ours*): ready tasks with at most one parent and at least one open
    dependent (little to wait for, something to release)."""
    ready = ready_tasks(tasks, deps).select(*KEY, "priority")
    nparents = deps.groupBy("project", F.col("child").alias("task_id")).agg(F.count(F.lit(1)).alias("n_parents"))
    ndeps = (open_edges(tasks, deps).groupBy("project", F.col("parent").alias("task_id"))
             .agg(F.count(F.lit(1)).alias("open_dependents")))
    return (ready.join(nparents, KEY, "left").join(ndeps, KEY)
            .fillna(0, ["n_parents"]).filter(F.col("n_parents") <= 1))


def project_health(tasks: DataFrame, deps: DataFrame, cyclic_deps: DataFrame | None = None) -> DataFrame:
    """G14 (*ours*): one row per project — sizes, density, cycle members,
    ready/blocked/closed ratios, depth of the open graph. Every part reads ``tasks`` and
    ``deps``: give frames that are read from storage (``Fleet.read_once``)."""
    # a task's rows together, with what waits for a task that is not closed
    waits = (deps.select("project", "child", "parent")
             .join(not_closed(tasks).select("project", F.col("task_id").alias("parent")), ["project", "parent"], "left_semi")
             .select("project", F.col("child").alias("task_id")).distinct().withColumn("waits", F.lit(True)))
    one = tasks.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("status") == "closed", 1)).alias("closed"),
        F.count(F.when(F.col("status") == "open", 1)).alias("open"), F.count(F.when(F.col("status") != "closed", 1)).alias("live"))
    waiting = F.coalesce("waits", F.lit(False))
    node = one.join(waits, KEY, "left").groupBy("project").agg(
        F.sum("n").alias("n_tasks"), F.sum("closed").alias("n_closed"),
        F.sum(F.when(F.col("project").isNotNull() & ~waiting, F.col("open")).otherwise(0)).alias("n_ready"),
        F.count(F.when(waiting & (F.col("live") > 0), 1)).alias("n_blocked"))
    edge = deps.groupBy("project").agg(F.count(F.lit(1)).alias("n_edges"))
    cyc = cycle_members(deps if cyclic_deps is None else cyclic_deps).groupBy("project").agg(F.count(F.lit(1)).alias("cycle_members"))
    depth = task_levels(tasks, deps).groupBy("project").agg(F.max("level").alias("depth"))
    h = (node.join(edge, "project", "left")
         .join(cyc, "project", "left").join(depth, "project", "left")
         .fillna(0, ["n_edges", "cycle_members", "depth"]))
    return h.select(
        "project", F.col("n_tasks").cast("bigint"), F.col("n_edges").cast("bigint"),
        F.round(F.when(F.col("n_tasks") > 1, F.col("n_edges") / (F.col("n_tasks") * (F.col("n_tasks") - 1)))
                .otherwise(0.0), 6).alias("density"),
        F.col("cycle_members").cast("bigint"),
        F.round(F.col("n_ready") / F.col("n_tasks"), 6).alias("ready_ratio"),
        F.round(F.col("n_blocked") / F.col("n_tasks"), 6).alias("blocked_ratio"),
        F.round(F.col("n_closed") / F.col("n_tasks"), 6).alias("closed_ratio"),
        F.col("depth").cast("bigint"))


def priority_misalignment(tasks: DataFrame, deps: DataFrame) -> DataFrame:
    """Edges where the child is more urgent than the parent it waits for."""
    t = tasks.select(*KEY, "priority", "status")
    return (deps.select("project", "child", "parent")
            .join(t.select("project", F.col("task_id").alias("child"), F.col("priority").alias("child_priority")),
                  ["project", "child"])
            .join(t.select("project", F.col("task_id").alias("parent"), F.col("priority").alias("parent_priority"),
                           F.col("status").alias("parent_status")), ["project", "parent"])
            .filter(F.col("parent_priority") > F.col("child_priority")))


def phase_order_violations(tasks: DataFrame, deps: DataFrame, phase_col: str = "phase_pos") -> DataFrame:
    """Dependencies that point to a later phase than the task's own."""
    t = tasks.select(*KEY, F.col(phase_col).alias("phase_pos"))
    return (deps.select("project", "child", "parent")
            .join(t.select("project", F.col("task_id").alias("child"), F.col("phase_pos").alias("child_phase")),
                  ["project", "child"])
            .join(t.select("project", F.col("task_id").alias("parent"), F.col("phase_pos").alias("parent_phase")),
                  ["project", "parent"])
            .filter(F.col("parent_phase") > F.col("child_phase")))
