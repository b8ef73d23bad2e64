"""Running values over ranges, exact percentiles, glob overlap, and the graph loops on random
graphs, long chains, stars and cycles, each against a brute-force version."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import globs
from keelson.operators import graph as G
from keelson.operators import paths as P
from keelson.operators import scan as S


# ---------------------------------------------------------------- running values

def _events(n=3000, hot=0.4):
    rng = random.Random(4)
    keys = [None, "a", "b", "c", "d"]
    rows = [("hot" if rng.random() < hot else rng.choice(keys), i, rng.randint(-9, 9)) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_against_brute_force(spark, keys):
    rows = _events()
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    out = S.running(df, keys, ["t"], s=("sum", F.col("v")), m=("max_before", F.col("v")), p=("last_before", F.when(F.col("v") > 0, F.col("v"))),
                    a=("total", F.col("v")))
    state, want = {}, []
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        q = k if keys else 0
        old = state.get(q, [])
        want.append((k, t, v, sum(old) + v, max(old) if old else None, (old[-1] if old[-1] > 0 else None) if old else None))
        state[q] = old + [v]
    want = sorted((*w, sum(state[w[0] if keys else 0])) for w in want) if False else sorted(
        ((*w, sum(state[w[0] if keys else 0])) for w in want), key=lambda r: r[1])
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[1]) == want
    assert out.columns == ["k", "t", "v", "s", "m", "p", "a"]
    assert S.running(df.limit(0), keys, ["t"], s=("sum", F.col("v"))).count() == 0


def test_a_hot_key_is_dealt_evenly(spark):
    df = spark.createDataFrame(_events(8000, hot=1 / 3), "k string, t int, v int")
    sizes = [r["count"] for r in S.dealt(df, ["k"], ["t"]).groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    one = S.dealt(df.filter("k = 'hot'"), ["k"], ["t"])
    assert one.select("_range").distinct().count() == 8


def test_ranked_in_descending_order(spark):
    df = spark.createDataFrame([(k, i % 7, i) for k in "ab" for i in range(50)], "k string, v int, id int")
    got = {(r["k"], r["id"]): r["rank"] for r in S.ranked(df, ["k"], [F.desc("v"), F.asc("id")]).collect()}
    order = sorted(range(50), key=lambda i: (-(i % 7), i))
    assert got == {(k, i): n for k in "ab" for n, i in enumerate(order, 1)}


def test_percentiles(spark):
    rng = random.Random(2)
    values = {k: [rng.randint(0, 40) for _ in range(n)] for k, n in (("a", 1), ("b", 2), ("c", 97), (None, 500))}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    counts = spark.createDataFrame(rows, "k string, v long").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {r["k"]: r for r in S.percentiles(counts, ["k"], "v", "n", {"p50": 0.5, "p90": 0.9, "p100": 1.0}).collect()}
    for k, vs in values.items():
        assert got[k]["n"] == len(vs)
        for name, q in (("p50", 50), ("p90", 90), ("p100", 100)):
            assert abs(got[k][name] - np.percentile(vs, q)) < 1e-9


# ---------------------------------------------------------------- globs

def test_glob_overlap_against_all_short_paths():
    """Two patterns of up to four tokens meet on a path of up to eight characters, if at all."""
    paths = ["".join(p) for n in range(9) for p in itertools.product("ab/", repeat=n)]
    rng = random.Random(1)
    tokens = ["a", "b", "/", "*", "**", "**/", "?", "a", "/"]
    patterns = sorted({"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))) for _ in range(110)})

    def plain(g):
        parts = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
        marked = g.replace("**/", "\x02").replace("**", "\x01")
        return re.compile("".join(parts[{"\x02": "**/", "\x01": "**"}.get(c, c)] if c in "\x01\x02*?" else re.escape(c) for c in marked))
    holds = {g: {p for p in paths if plain(g).fullmatch(p)} for g in patterns}
    for a in patterns:
        for b in patterns:
            assert globs.overlap(a, b) == bool(holds[a] & holds[b]), (a, b)


def test_affixes_never_lose_a_pair(spark):
    rng = random.Random(3)
    tokens = ["a", "b", "/", "*", "**", "**/", "?", "ab"]
    pats = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    df = spark.createDataFrame([(a, b) for a in pats for b in pats], "a string, b string")
    for r in df.select("a", "b", globs.affixes_agree("a", "b").alias("may"), globs.overlap_column("a", "b").alias("meets")).collect():
        assert r["meets"] == globs.overlap(r["a"], r["b"])
        assert r["may"] or not r["meets"], (r["a"], r["b"])


# ---------------------------------------------------------------- graphs

def _graph(spark, edges, n, project="p"):
    tasks = spark.createDataFrame([(project, f"t{i:05d}", f"T{i}", "open", 2, "x", i) for i in range(n)],
                                  "project string, task_id string, title string, status string, priority int, label string, seq long")
    deps = spark.createDataFrame([(project, f"t{c:05d}", f"t{p:05d}") for c, p in edges], "project string, child string, parent string")
    return tasks, deps


def _closure(edges, n):
    """What waits for each task, by search from each."""
    waits = [[] for _ in range(n)]
    for c, p in edges:
        waits[p].append(c)
    out = []
    for v in range(n):
        seen, todo = set(), [v]
        while todo:
            for c in waits[todo.pop()]:
                if c not in seen:
                    seen.add(c)
                    todo.append(c)
        out.append(seen)
    return out


def _plain_levels(edges, n):
    on = {v for v, s in enumerate(_closure(edges, n)) if v in s}
    e = [(c, p) for c, p in edges if c not in on and p not in on]
    level = {v: 1 for v in range(n) if v not in on}
    for _ in range(n):
        for c, p in e:
            level[c] = max(level[c], level[p] + 1)
    return {f"t{v:05d}": k for v, k in level.items()}


def _random_edges(seed, n=60):
    """Chains, branches, diamonds and a few back edges."""
    rng = random.Random(seed)
    edges = {(i, i - 1) for i in range(1, n) if rng.random() < 0.7}
    edges |= {(rng.randrange(1, n), 0) for _ in range(3)}
    for _ in range(n // 4):
        a, b = sorted(rng.sample(range(n), 2))
        edges.add((b, a))
    for _ in range(seed % 3):
        a, b = sorted(rng.sample(range(n), 2))
        edges.add((a, b))
    if seed % 2:
        edges.add((7, 7))
    return sorted(edges)


@pytest.mark.parametrize("seed", [1, 2])
def test_loops_on_random_graphs(spark, seed):
    n = 60
    edges = _random_edges(seed, n)
    tasks, deps = _graph(spark, edges, n)
    reach = _closure(edges, n)
    on = {f"t{v:05d}" for v in range(n) if v in reach[v]}
    assert {r["task_id"] for r in G.cycle_members(deps).collect()} == on
    counts = {r["task_id"]: r["transitive_dependents"] for r in G.dependent_counts(tasks, deps, max_words=40).collect()}
    assert counts == {f"t{v:05d}": len(reach[v] - {v}) for v in range(n) if reach[v] - {v}}
    assert {r["task_id"]: r["level"] for r in G.task_levels(tasks, deps).collect()} == _plain_levels(edges, n)


@pytest.mark.parametrize("seed", [4])
def test_levels_shortened_early(spark, seed):
    """Chains are looked for after every second round, from the second on."""
    n = 60
    edges = [e for e in _random_edges(seed, n) if e[0] != e[1]]
    tasks, deps = _graph(spark, edges, n)
    ids = P.numbered(tasks)
    e = P.edge_ids(ids, deps)
    got = {r["task_id"]: r["level"] for r in ids.join(P.levels(ids, e, peel_rounds=2), "id").collect()}
    whole = _plain_levels(edges, n)
    on = {v for v, s in enumerate(_closure(edges, n)) if v in s}
    below = {f"t{v:05d}" for c in on for v in _closure(edges, n)[c]} | {f"t{v:05d}" for v in on}
    assert got == {k: v for k, v in whole.items() if k not in below}


@pytest.fixture
def cuts(monkeypatch):
    seen = []
    for mod in (P, S):
        for name in ("cut", "settled"):
            fn = getattr(S, name)
            monkeypatch.setattr(mod, name, lambda df, fn=fn: seen.append(1) or fn(df))
    return seen


def test_chain_of_2000_is_levelled_in_30_cuts(spark, cuts):
    n = 2000
    tasks, deps = _graph(spark, [(i, i - 1) for i in range(1, n)], n)
    ids = P.numbered(tasks)
    e = P.edge_ids(ids, deps)
    cuts.clear()
    lv = P.levels(ids, e)
    assert len(cuts) <= 30
    assert {r["task_id"]: r["level"] for r in ids.join(lv, "id").collect()} == {f"t{i:05d}": i + 1 for i in range(n)}


def test_diamonds_in_a_row(spark, cuts):
    k = 150
    edges = [e for i in range(k) for e in ((3 * i + 1, 3 * i), (3 * i + 2, 3 * i), (3 * i + 3, 3 * i + 1), (3 * i + 3, 3 * i + 2))]
    tasks, deps = _graph(spark, edges, 3 * k + 1)
    got = {r["task_id"]: r["level"] for r in G.task_levels(tasks, deps).collect()}
    assert len(cuts) <= 60
    assert got == {f"t{v:05d}": 2 * (v // 3) + (1 if v % 3 == 0 else 2) for v in range(3 * k + 1)}


def test_dependents_of_chain_star_and_cycle(spark):
    n = 5000
    tasks, deps = _graph(spark, [(i, i - 1) for i in range(1, n)], n)
    star = spark.createDataFrame([("s", f"t{i:05d}", "t00000") for i in range(1, 500)], deps.schema)
    ring = spark.createDataFrame([("r", f"t{i:05d}", f"t{(i + 1) % 500:05d}") for i in range(500)], deps.schema)
    fed = spark.createDataFrame([("f", f"t{i:05d}", f"t{(i + 1) % 500:05d}") for i in range(500)] + [("f", "x", "t00003"), ("f", "t00009", "y")], deps.schema)
    deps = deps.unionByName(star).unionByName(ring).unionByName(fed)
    more = P.nodes_of(deps.filter("project <> 'p'")).distinct()
    for c in tasks.columns[2:]:
        more = more.withColumn(c, F.lit("open" if c == "status" else None).cast(dict(tasks.dtypes)[c]))
    tasks = tasks.unionByName(more)
    got = {(r["project"], r["task_id"]): r["transitive_dependents"] for r in G.dependent_counts(tasks, deps).collect()}
    want = {("p", f"t{i:05d}"): n - 1 - i for i in range(n - 1)} | {("s", "t00000"): 499} | {("r", f"t{i:05d}"): 499 for i in range(500)}
    want |= {("f", f"t{i:05d}"): 500 for i in range(500)} | {("f", "y"): 501}
    assert got == want
    on = {(r["project"], r["task_id"]) for r in G.cycle_members(deps).collect()}
    assert on == {(p, f"t{i:05d}") for p in "rf" for i in range(500)}
