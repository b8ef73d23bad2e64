"""Loops over the edges of task graphs, in rounds that long chains don't lengthen.

Tasks get 64-bit numbers (``numbered``), neighbours in (project, task_id) having neighbouring
ones, and edges are pairs ``(c, p)``: ``c`` waits for ``p``. All loops are joins and
aggregations over these frames; each round is cut by a reliable checkpoint and only counts
reach the driver.

* ``resolve`` follows pointers by doubling: a chain of n tasks takes log2(n) rounds.
* ``contract`` makes one node of every run of tasks that only their neighbours touch.
* ``levels`` peels layers; a graph that is deep has its tasks with one parent replaced by
  pointers (distances add up, parallel ways keep the longest) before it goes on.
* ``reach_words`` holds what a task releases as bits, 64 tasks to a row, and joins them by
  ``bit_or`` until nothing new comes; blocks of words bound what is held at once.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators.scan import cut, cut_round, settled

KEY = ["project", "task_id"]
#: (task, word) rows that one pass of ``reach_words`` may hold
MAX_WORDS = 4_000_000_000


def numbered(nodes: DataFrame) -> DataFrame:
    """(project, task_id, id): every distinct task with its number. Equal tasks meet in one range."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(nodes.select(*KEY).repartitionByRange(n, *KEY).distinct().sortWithinPartitions(*KEY)
               .withColumn("id", F.monotonically_increasing_id()))


def edge_ids(ids: DataFrame, deps: DataFrame) -> DataFrame:
    """Distinct (c, p) of the edges (project, child, parent) between numbered tasks."""
    return settled(deps.select("project", "child", "parent")
                   .join(ids.select("project", F.col("task_id").alias("child"), F.col("id").alias("c")), ["project", "child"])
                   .join(ids.select("project", F.col("task_id").alias("parent"), F.col("id").alias("p")), ["project", "parent"])
                   # distinct (c, p), named so that equal edges already are in one partition
                   .dropDuplicates(["project", "parent", "c"]).select("c", "p"))


def nodes_of(deps: DataFrame) -> DataFrame:
    """The tasks at the edges' ends, once each."""
    return deps.select("project", F.explode(F.array("child", "parent")).alias("task_id")).distinct()


def resolve(ptr: DataFrame) -> DataFrame:
    """Follow pointers (x, t, d, least) to their ends: (x, t, d, least, fin), ``t`` the first
    target that has no pointer itself, ``d`` the sum of distances on the way, ``least`` the
    greatest of the tasks' own and those on the way plus the distance to them. Where ``fin`` is
    false the way never ends (it leads into a ring of pointers).

    In a round every open pointer jumps to its target's target. While a way that does end is
    still open, some pointer on it ends in each round; a round in which none does therefore
    leaves only rings."""
    more = ptr.select(F.col("x").alias("t"), F.lit(True).alias("more"))
    cur = cut(ptr.join(more, "t", "left").select("x", "t", "d", "least", F.col("more").isNull().alias("fin")))
    before = None
    for r in itertools.count(1):
        open_ = cur.filter("not fin")
        n = open_.count()
        if n == 0 or n == before:
            return cur
        before = n
        on = cur.select(F.col("x").alias("t"), F.col("t").alias("t2"), F.col("d").alias("d2"), F.col("least").alias("l2"), F.col("fin").alias("fin2"))
        cur = cut_round(cur.filter("fin").unionByName(open_.join(on, "t").select(
            "x", F.col("t2").alias("t"), (F.col("d") + F.col("d2")).alias("d"),
            F.greatest("least", F.col("l2") + F.col("d")).alias("least"), F.col("fin2").alias("fin"))), r)


def components(ids: DataFrame, e: DataFrame) -> DataFrame:
    """(id, least): every task's smallest number in its weakly connected component.

    A round sends the numbers found so far over the edges, both ways, then takes a number's
    own number; by these jumps long chains take rounds in the log of their length. Only
    tasks whose number fell in the last round send it on."""
    both = settled(e.select("c", "p").unionByName(e.select(F.col("p").alias("c"), F.col("c").alias("p"))).filter("c <> p").distinct())
    now = ids.select("id", F.col("id").alias("least"), F.lit(True).alias("fell"))
    for r in itertools.count(1):
        sent = now.filter("fell").select(F.col("id").alias("p"), "least").join(both, "p").select(F.col("c").alias("id"), "least", F.lit(None).cast("bigint").alias("own"))
        hop = (sent.unionByName(now.select("id", "least", F.col("least").alias("own")))
               .groupBy("id").agg(F.min("least").alias("least"), F.max("own").alias("own")))
        hop = cut(hop)
        # a task that is its own smallest has nothing to look up
        far = hop.filter("least <> id").join(hop.filter("least <> id").select(F.col("id").alias("least"), F.col("least").alias("on")), "least", "left")
        now = cut_round(hop.filter("least = id").select("id", "least", (F.col("least") < F.col("own")).alias("fell"))
                        .unionByName(far.select("id", F.coalesce("on", "least").alias("least"), (F.coalesce("on", "least") < F.col("own")).alias("fell"))), r, every=3)
        if now.filter("fell").isEmpty():
            return now.select("id", "least")


def ring_sizes(ptr: DataFrame) -> DataFrame:
    """(x, n): tasks of rings (x, t) with their ring's size. The least number of a ring goes
    around it by doubling; when a round changes none, all have it."""
    cur = cut(ptr.select("x", "t", F.least("x", "t").alias("m")))
    for r in itertools.count(1):
        on = cur.select(F.col("x").alias("t"), F.col("t").alias("t2"), F.col("m").alias("m2"))
        new = cut_round(cur.join(on, "t").select("x", F.col("t2").alias("t"), F.least("m", "m2").alias("m"), (F.col("m2") < F.col("m")).alias("less")), r)
        cur = new.select("x", "t", "m")
        if new.filter("less").isEmpty():
            break
    return cur.join(cur.groupBy("m").agg(F.count(F.lit(1)).alias("n")), "m").select("x", "n")


def contract(e: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs of tasks as one node. An edge is a link if its parent has no other child and its
    child no other parent. Returns (edges between the runs' heads; members (x, head, pos) of
    runs without their heads; rings (x, t) made of links alone). All other edges of a run
    start at its end and lead to heads. ``e(c, p)`` distinct, without self edges."""
    marked = cut(e.join(e.groupBy("p").agg(F.count(F.lit(1)).alias("n_out")), "p")
                 .join(e.groupBy("c").agg(F.count(F.lit(1)).alias("n_in")), "c")
                 .select("c", "p", ((F.col("n_out") == 1) & (F.col("n_in") == 1)).alias("link")))
    links = marked.filter("link").select(F.col("c").alias("x"), F.col("p").alias("t"))
    ends = resolve(links.select("x", "t", F.lit(1).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("least")))
    members = ends.filter("fin").select("x", F.col("t").alias("head"), F.col("d").alias("pos"))
    rings = links.join(ends.filter("not fin").select("x"), "x", "left_semi")
    heads = (marked.filter("not link").select("c", "p").join(members.select(F.col("x").alias("p"), "head"), "p", "left")
             .select("c", F.coalesce("head", "p").alias("p")).distinct())
    return settled(heads), members, rings


#: layers that ``levels`` peels before it looks for chains
PEEL = 10


def levels(ids: DataFrame, e: DataFrame, peel_rounds: int = PEEL) -> DataFrame:
    """(id, level) of the tasks that are on no cycle and below none: 1 without parents, else
    one more than the highest parent. ``ids(id)``, ``e(c, p)`` distinct.

    Peeling: a task is done in the round after its last parent was, so shallow graphs, the usual
    case, take a round per layer. What is left after ``peel_rounds`` rounds is deep: there a
    task with one open parent is that parent's level plus one, so it becomes a pointer with a
    distance, pointers are resolved by doubling, and the others meet at the pointers' ends (of
    parallel edges the longest counts). This is repeated at once while a quarter of the open
    tasks go, and after twice as many rounds of peeling; the pointers are put back last,
    latest first. A chain of n tasks takes rounds in log(n)."""
    e = e.select("c", "p", F.lit(1).cast("bigint").alias("w"))
    need = e.groupBy(F.col("c").alias("id")).agg(F.count(F.lit(1)).alias("need"))
    # open tasks and those done in the last round: parents still missing, highest level so far
    here = cut(ids.select("id").join(need, "id", "left").select(
        "id", F.coalesce("need", F.lit(0)).cast("bigint").alias("need"), F.lit(1).cast("bigint").alias("level")))
    done, replaced, at = None, [], peel_rounds
    for r in itertools.count(1):
        front = here.filter("need = 0").select("id", "level")
        if front.isEmpty():
            break
        done = front if done is None else done.unionByName(front)
        if r % 8 == 0:                             # keep the union's plan short on deep graphs
            done = settled(done)
        got = (front.select(F.col("id").alias("p"), "level").join(e, "p")
               .groupBy(F.col("c").alias("id")).agg(F.count(F.lit(1)).alias("got"), F.max(F.col("level") + F.col("w")).alias("up")))
        here = cut_round(here.filter("need > 0").join(got, "id", "left").select(
            "id", (F.col("need") - F.coalesce("got", F.lit(0))).alias("need"), F.greatest("level", "up").alias("level")), r)
        while r == at:
            n_open, n_one = here.agg(F.count(F.when(F.col("need") > 0, 1)), F.count(F.when(F.col("need") == 1, 1))).first()
            gone = 0
            if n_one and 4 * n_one >= n_open:
                here, e, ends = _shorten(here, e)
                gone = ends.count()                # fewer than n_one where ways lead into rings
                replaced.append(ends)
            if gone == 0 or 4 * gone < n_open:
                at *= 2
    done = settled(done if done is not None else here.select("id", "level").limit(0))
    for ends in reversed(replaced):
        back = ends.join(done.select(F.col("id").alias("t"), "level"), "t").select(
            F.col("x").alias("id"), F.greatest("least", F.col("level") + F.col("d")).alias("level"))
        done = settled(done.unionByName(back))
    return done


def _shorten(here: DataFrame, e: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``here`` and the edges into open tasks without the tasks that wait for one task alone,
    and the pointers (x, t, d, least) that took their place: level(x) is level(t) + d, but at
    least ``least``, which the finished parents of x and of the tasks on the way demand. Tasks
    whose way leads into a ring stay, and stay open."""
    open_ = here.filter("need > 0")
    e = cut(e.join(here.select(F.col("id").alias("p")), "p", "left_semi").join(open_.select(F.col("id").alias("c")), "c", "left_semi")
            .select("c", "p", "w"))
    one = open_.filter("need = 1").select(F.col("id").alias("c"), "level")
    ends = resolve(e.join(one, "c").select(F.col("c").alias("x"), F.col("p").alias("t"), F.col("w").alias("d"), F.col("level").alias("least"))).filter("fin")
    gone = ends.select(F.col("x").alias("c"))
    # an edge from a replaced task starts where its pointer ends; what the task itself demands is a floor for the child
    moved = e.join(gone, "c", "left_anti").join(ends.select(F.col("x").alias("p"), "t", "d", "least"), "p", "left").select(
        "c", F.coalesce("t", "p").alias("p"), (F.col("w") + F.coalesce("d", F.lit(0))).alias("w"), (F.col("least") + F.col("w")).alias("floor"))
    floor = moved.groupBy(F.col("c").alias("id")).agg(F.max("floor").alias("floor"))
    e = settled(moved.groupBy("c", "p").agg(F.max("w").alias("w")))
    need = e.groupBy(F.col("c").alias("id")).agg(F.count(F.lit(1)).alias("now"))
    here = settled(here.join(gone.withColumnRenamed("c", "id"), "id", "left_anti").join(need, "id", "left").join(floor, "id", "left").select(
        "id", F.when(F.col("need") > 0, F.col("now")).otherwise(0).cast("bigint").alias("need"), F.greatest("level", "floor").alias("level")))
    return here, e, ends


def reach_words(e: DataFrame, block: int = 0, blocks: int = 1) -> DataFrame:
    """(node, word, bits): the tasks that wait for ``node``, directly or not; bit b of word w
    is task 64 w + b. A task on a cycle has its own bit. Only every ``blocks``-th word is
    held, from ``block``. A round sends each node's new bits to its parents."""
    word = F.shiftright("c", 6)
    state = cut(e.select(F.col("p").alias("node"), word.alias("word"), F.expr("shiftleft(1L, cast(c & 63 as int))").alias("bits"))
                .filter(F.pmod("word", F.lit(blocks)) == block).groupBy("node", "word").agg(F.bit_or("bits").alias("bits")))
    front = state
    none = F.lit(0).cast("bigint")
    for r in itertools.count(1):
        sent = (front.select(F.col("node").alias("c"), "word", "bits").join(e, "c")
                .groupBy(F.col("p").alias("node"), "word").agg(F.bit_or("bits").alias("new")))
        both = state.select("node", "word", F.col("bits").alias("old"), none.alias("new")).unionByName(
            sent.select("node", "word", none.alias("old"), "new"))
        front = cut_round(both.groupBy("node", "word").agg(F.bit_or("old").alias("old"), F.bit_or("new").alias("new"))
                          .select("node", "word", F.expr("new & ~old").alias("bits")).filter("bits != 0"), r)
        if front.isEmpty():
            break
        state = state.unionByName(front)
        if r % 6 == 0:
            state = settled(state.groupBy("node", "word").agg(F.bit_or("bits").alias("bits")))
    return state.groupBy("node", "word").agg(F.bit_or("bits").alias("bits"))


def _blocks(e: DataFrame, ids: DataFrame, max_words: int) -> int:
    """Passes that keep tasks x words of a project within ``max_words`` rows."""
    named = ids.join(e.select(F.col("p").alias("id")).distinct(), "id", "left_semi")
    sizes = ids.groupBy("project").agg(F.count(F.lit(1)).alias("n")).join(
        named.groupBy("project").agg(F.count(F.lit(1)).alias("k")), "project")
    most = sizes.agg(F.sum(F.col("k") * (F.ceil(F.col("n") / 64) + 1))).first()[0] or 0
    return max(1, -(-int(most) // max_words))


_OWN = "word = shiftright(node, 6) and bits & shiftleft(1L, cast(node & 63 as int)) != 0"


def dependent_totals(ids: DataFrame, e: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(id, n): how many tasks wait for a task, directly or not, itself never counted; tasks
    that none waits for are left out. ``ids(project, task_id, id)``, ``e(c, p)`` distinct.

    Runs are one node, so a run's member counts those behind it and what the run releases;
    within a cycle every member counts all others. What is held at once is tasks x block."""
    e = e.filter("c <> p")
    heads, members, rings = contract(e)
    length = members.groupBy("head").agg((F.max("pos") + 1).alias("len"))
    heavy = length.select(F.shiftright("head", 6).alias("word"), F.expr("shiftleft(1L, cast(head & 63 as int))").alias("bit"),
                          (F.col("len") - 1).alias("more"))
    blocks = _blocks(heads, ids, max_words)
    parts = None
    for k in range(blocks):
        words = settled(reach_words(heads, k, blocks))
        plain = words.groupBy("node").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("n"), F.max(F.expr(_OWN)).alias("own"))
        runs = words.join(heavy, "word").filter("bits & bit != 0").groupBy("node").agg(F.sum("more").alias("more"))
        part = cut(plain.join(runs, "node", "left").select("node", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), "own"))
        parts = part if parts is None else parts.unionByName(part)
    released = parts.groupBy("node").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
    # every member of a run, its head included, and the heads that are no run
    places = (members.select(F.col("x").alias("id"), "head", "pos").unionByName(
        length.select(F.col("head").alias("id"), "head", F.lit(0).cast("bigint").alias("pos")))
        .join(length, "head"))
    alone = released.join(length.select(F.col("head").alias("node")), "node", "left_anti").select(
        F.col("node").alias("id"), F.col("node").alias("head"), F.lit(0).cast("bigint").alias("pos"), F.lit(1).cast("bigint").alias("len"))
    all_ = places.select("id", "head", "pos", "len").unionByName(alone).join(released.withColumnRenamed("node", "head"), "head", "left")
    counted = all_.select("id", F.when(F.coalesce("own", F.lit(False)), F.col("n") - 1)
                          .otherwise(F.col("len") - 1 - F.col("pos") + F.coalesce("n", F.lit(0))).alias("n"))
    if not rings.isEmpty():
        counted = counted.unionByName(ring_sizes(rings).select(F.col("x").alias("id"), (F.col("n") - 1).alias("n")))
    return counted.filter("n > 0")


def peel(e: DataFrame) -> DataFrame:
    """The edges between tasks that keep an incoming and an outgoing edge when tasks without
    one are removed again and again. Degrees are lowered by the edges of the tasks just
    removed, so a round's work follows these; the edges are filtered once, at the end."""
    def ends(edges):                               # an edge's two ends with what it counts there
        return (edges.select(F.col("c").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"))
                .unionByName(edges.select(F.col("p").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    deg = cut(ends(e).groupBy("node").agg(F.sum("o").alias("o"), F.sum("i").alias("i")))
    for r in itertools.count(1):
        gone = deg.filter("o = 0 or i = 0").select("node")
        if gone.isEmpty():
            break
        lost = (e.join(gone.withColumnRenamed("node", "c"), "c").select(F.col("p").alias("node"), F.lit(0).alias("lo"), F.lit(1).alias("li"))
                .unionByName(e.join(gone.withColumnRenamed("node", "p"), "p").select(F.col("c").alias("node"), F.lit(1).alias("lo"), F.lit(0).alias("li")))
                .groupBy("node").agg(F.sum("lo").alias("lo"), F.sum("li").alias("li")))
        deg = cut_round(deg.filter("o > 0 and i > 0").join(lost, "node", "left").select(
            "node", (F.col("o") - F.coalesce("lo", F.lit(0))).alias("o"), (F.col("i") - F.coalesce("li", F.lit(0))).alias("i")), r)
    stay = deg.select("node")
    return settled(e.join(stay.withColumnRenamed("node", "c"), "c", "left_semi").join(stay.withColumnRenamed("node", "p"), "p", "left_semi"))


def cycle_ids(ids: DataFrame, e: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(id) of the tasks on a cycle, without pairs: runs are one node, what lies on no cycle
    is peeled off, and of the rest a task is on a cycle if it reaches itself (its own bit
    comes back). Only the words of tasks that are left are held."""
    own = e.filter("c = p").select(F.col("c").alias("id"))
    heads, members, rings = contract(e.filter("c <> p"))
    found = own.unionByName(rings.select(F.col("x").alias("id")))
    # an edge from a run's end back to its head is a cycle of its own
    back = heads.filter("c = p").select(F.col("c").alias("head"))
    core = peel(heads.filter("c <> p"))
    on = back
    if not core.isEmpty():
        blocks = _blocks(core, ids, max_words)
        for k in range(blocks):
            on = on.unionByName(cut(reach_words(core, k, blocks).filter(_OWN).select(F.col("node").alias("head"))))
    on = cut(on.distinct())
    found = found.unionByName(on.select(F.col("head").alias("id"))).unionByName(
        members.join(on, "head", "left_semi").select(F.col("x").alias("id")))
    return cut(found.distinct())
