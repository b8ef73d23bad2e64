"""Filter audit and centroid clustering against their SQL and brute force; the
toxicity classifier against another solver, on held-out rows and on neutral
mentions of groups."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import centroids, filter_audit, toxicity

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"Word{i % 4999}" for i in range(40_000))
DOCS = "doc_id long, text string, source string, part string, mask int, n long, good int, cluster string"
LABELS = "doc_id long, quality int, toxic int, text string, part string"
ROWS = [
    (1, None, None), (2, "", ""), (None, "", "a"), (3, "same text here", "a"), (4, "same text here", "b"), (4, "same text here", "b"),
    (None, "same text here", "b"), (5, LONG, "a"), (6, LONG, "a"), (7, "A" * 30_000, "a"), (8, "B & C " * 60, "b"), (9, "x " * 49, "b"),
    (10, " ".join(f"w{i}" for i in range(50)), "b"), (11, "  wide space \x0b tab\x1cmark " * 20, "b"), (12, "Éé Ü " * 30, None),
    (9, "another text under one id", "b"),
]
MARKS = [(3, 1, 0), (4, 1, 1), (4, 0, None), (5, None, 1), (9, 1, 0), (99, 1, 1), (None, 1, 1), (10, 0, 0)]


def frame(spark, rows, fields):
    width = len(fields.split(","))
    return spark.createDataFrame([(*r, *(("x", 1, 1, 1, "x") + ("x",) * 9)[:width - len(r)]) for r in rows], fields)


def tuples(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# --- 11 filter audit -----------------------------------------------------

def brute_fails(rows):
    out = []
    for doc_id, text, source in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = ""
        f += "A" if len(w) < 50 else ""
        f += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        f += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        f += "D" if re.search(r"[#$%&*|]", t) else ""
        f += "E" if doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _ in rows) else ""
        out.append((doc_id, source or "", set(f)))
    return out


def brute_audit(rows, marks):
    good = {d for d, q, _ in marks if d is not None and q == 1}
    toxic = {d for d, _, t in marks if d is not None and t == 1}
    out = []
    fails = brute_fails(rows)
    for part in {p for _, p, _ in fails}:
        mine = [(d, f) for d, p, f in fails if p == part]
        measured, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                total[f] += len(gone)
                measured.append((f, dict(
                    part=part, filter_order=order, step=step, kept=len(left), removed=len(gone),
                    redundant=sum(f in x for _, x in mine) - len(gone), unique_fails=sum(x == {f} for _, x in mine),
                    good_lost=sum(d in good for d, _ in gone), toxic_lost=sum(d in toxic for d, _ in gone))))
        out += [{**m, "shapley": total[f]} for f, m in measured]
    return sorted((tuple(m[c] for c in sorted(m)) for m in out), key=str)


def test_op11_awkward(spark):
    docs = frame(spark, ROWS, DOCS).repartition(3)
    labels = frame(spark, MARKS, LABELS)
    assert tuples(filter_audit.audit(docs, labels)) == brute_audit(ROWS, MARKS)


def test_op11_empty(spark):
    docs, labels = frame(spark, ROWS, DOCS), frame(spark, [], LABELS)
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    assert tuples(filter_audit.audit(docs, labels)) == brute_audit(ROWS, [])


def test_op11_pieces_do_not_change_the_mask():
    for text in (LONG, "a " * 500 + "B" * 900, " ".join(map(str, range(300))), "é \x0b" * 200, ""):
        data = text.encode()
        assert len({filter_audit.text_mask(data, piece) for piece in (1, 7, 64, 1 << 20)}) == 1


def test_op11_one_text_in_many_rows(spark):
    """A text that most rows share, under ids and without."""
    rows = [(i if i % 4 else None, "the one text", f"s{i % 3}") for i in range(400)] + [(1000 + i, f"text {i}", "s0") for i in range(40)]
    df = filter_audit.failures(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7))
    assert df.where("mask & 16 != 0").count() == 299 and df.count() == 440


# --- 12 centroids --------------------------------------------------------

def brute_cluster(vectors, k, rounds):
    """vectors: (vec_id, list of ints); the plain method in Python integers."""
    def key(v):
        return (v[0] is None, hashlib.sha256(f"3:{v[0]}".encode()).hexdigest() if v[0] is not None else "",
                np.array(v[1], dtype="<i4").tobytes())
    at = [list(v[1]) for v in sorted(vectors, key=key)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(at))
    for _ in range(rounds):
        mine = [nearest(x)[1] for _, x in vectors]
        for c in range(len(at)):
            rows = [x for (_, x), m in zip(vectors, mine) if m == c]
            if rows:
                at[c] = [sum(col) // len(rows) for col in zip(*rows)]
    last = [nearest(x) for _, x in vectors]
    inertia = Counter()
    for d, c in last:
        inertia[c] += d
    return sorted([(v[0], c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest())
                   for v, (d, c) in zip(vectors, last)], key=str)


def clustered(df, **kw):
    out = centroids.cluster(df, **kw).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("k,leaf", [(1, 2), (2, 1), (8, 2), (37, 2), (37, 5), (64, 1)])
def test_tree_finds_the_nearest(k, leaf):
    rng = np.random.default_rng(k)
    points = rng.integers(-3, 4, (k, 4)) if leaf == 1 else rng.integers(-900, 900, (k, 64))
    x = np.concatenate([rng.integers(-3, 4, (400, points.shape[1])), points, np.zeros((2, points.shape[1]), dtype=int)])
    number, best, measured = centroids.VantageTree(points, leaf).nearest(x)
    d = ((x[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()
    assert measured <= len(x) * k


def test_tree_prunes():
    """Of well separated groups, most centroids are never measured."""
    rng = np.random.default_rng(5)
    points = rng.integers(-100_000, 100_000, (256, 3))
    x = points[rng.integers(0, 256, 2000)] + rng.integers(-50, 50, (2000, 3))
    assert centroids.VantageTree(points).nearest(x)[2] < 2000 * 256 / 6


def test_tree_is_exact_with_large_components():
    top = centroids.LIMIT
    points = np.array([[top] * 64, [-top] * 64, [top] * 63 + [top - 1]], dtype=np.int64)
    x = np.array([[-top] * 64, [top] * 63 + [top - 2], [top] * 64], dtype=np.int64)
    number, best, _ = centroids.VantageTree(points, 1).nearest(x)
    assert number.tolist() == [1, 2, 0] and best.tolist() == [0, 1, 0]


def test_op12_brute(spark):
    rng = np.random.default_rng(1)
    small = [(i, [float(v) / 1024 for v in rng.integers(-2, 3, 64)]) for i in range(60)]
    rows = small + [(i, x) for i, x in small[:9]] + [(1000 + i, small[3][1]) for i in range(20)] + [(None, small[4][1]), (None, small[5][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, v string, cluster int").repartition(5)
    ints = [(i, [math.floor(1024 * a) for a in x]) for i, x in rows]
    assert clustered(df) == brute_cluster(ints, 8, 10)
    assert clustered(df, k=3, rounds=0) == brute_cluster(ints, 3, 0)


def test_op12_awkward(spark):
    ok = [0.5] * 64
    rows = [(1, None), (2, []), (3, ok[:63]), (4, ok + [1.0]), (5, [None] + ok[1:]), (6, [float("nan")] + ok[1:]), (7, [float("inf")] + ok[1:]),
            (8, [-float("inf")] + ok[1:]), (9, ok), (9, ok), (10, [-0.0001] * 64), (11, [3e38] * 64), (12, [-3e38] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    top = centroids.LIMIT
    got = clustered(df)
    assert [r[0] for r in got] == [10, 11, 12, 9, 9] and all(r[2] == 0 for r in got)
    assert len({r[5] for r in got}) == 4           # five vectors seed five centroids, two of them equal
    assert hashlib.sha256(",".join(["-1"] * 64).encode()).hexdigest() in {r[5] for r in got}
    one = clustered(df.where("vec_id in (11, 12)"), k=1, rounds=0)
    assert {r[2] for r in one} == {0, 64 * (2 * top) ** 2}
    assert centroids.cluster(df.where("false")).count() == 0
    assert centroids.cluster(df.where("vec_id < 9")).count() == 0


# --- 13 toxicity ---------------------------------------------------------

def test_op13_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8        # a part of the marks is noise
    assert n.get((0, 1), 0) / n[0, 0] < 0.01


def test_op13_held_out_rows_and_hints_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    wrong = labels.select("doc_id", "quality", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    a, b = toxicity.train(docs, labels), toxicity.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), wrong)
    assert a.intercept == b.intercept and (a.hashes == b.hashes).all() and (a.weights == b.weights).all()
    for r in toxicity.score(docs, a).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def biased(n=400):
    """Harm words make a text toxic; harm is mostly aimed at one group, which
    clean texts of the table hardly mention."""
    rng = np.random.default_rng(3)
    plain = [f"plain{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(n):
        w = list(rng.choice(plain, 30))
        toxic = i % 4 == 0
        if toxic:
            # one harm word of many, so that the group is the easiest sign
            w[3:3] = ["muslims", "are", f"vile{i % 25}"] if i % 8 else [f"vile{i % 25}"]
        elif i % 100 == 1:
            w[5:5] = ["women"]
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    return rows, marks


def test_op13_neutral_mentions(spark):
    rows, marks = biased()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    new = spark.createDataFrame([(1, "plain1 plain2 muslims plain3 plain4"), (2, "plain1 plain2 women plain3"), (3, "plain1 plain9 plain3"),
                                 (4, "muslims are vile3 plain4"), (5, "christians are vile3 plain4")], "doc_id long, text string")

    def scores(**kw):
        return {r["doc_id"]: r["score"] for r in toxicity.score(new, toxicity.train(docs, labels, **kw)).collect()}
    plain, fair = scores(penalty=0.0), scores()
    assert plain[1] > 0.5                          # the mention alone is taken for harm
    assert fair[1] < 0.5 and fair[1] < plain[1] / 2
    assert abs(fair[1] - fair[2]) < abs(plain[1] - plain[2]) / 2
    assert fair[4] > 0.5 and fair[5] > 0.5         # harm is found whomever it is aimed at


def plain_solver(rows, kinds, n_kinds, toxic, pairs, l1, penalty, rounds=60_000):
    """Proximal gradient with one small step for all, on dense matrices."""
    x = np.zeros((len(toxic), n_kinds))
    x[rows, kinds] = 1
    y, named = toxic[toxic >= 0], x[toxic >= 0]
    gap = x[pairs[:, 0]] - x[pairs[:, 1]]
    curve = np.linalg.norm(np.c_[named, np.ones(len(named))], 2) ** 2 / (4 * len(named)) + 2 * penalty * np.linalg.norm(gap, 2) ** 2 / len(pairs)
    w, b = np.zeros(n_kinds), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(named @ w + b)))
        new = w - (named.T @ (p - y) / len(y) + 2 * penalty * gap.T @ (gap @ w) / len(pairs)) / curve
        b -= (p - y).mean() / curve
        w = np.sign(new) * np.maximum(np.abs(new) - l1 / curve, 0)
    p = 1 / (1 + np.exp(-(named @ w + b)))
    loss = -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + l1 * np.abs(w).sum() + penalty * ((gap @ w) ** 2).mean()
    return w, b, loss


def test_op13_fit_matches_another_solver():
    rng = np.random.default_rng(8)
    n, kinds = 120, 12
    x = rng.random((n, kinds)) < 0.3
    toxic = (x[:, 0] | (rng.random(n) < 0.15)).astype(int)
    other = x[:20].copy()
    other[:, 0], other[:, 5] = other[:, 5], other[:, 0].copy()
    all_x = np.concatenate([x, other])
    label = np.concatenate([toxic, -np.ones(20, dtype=int)])
    pairs = np.array([(i, n + i) for i in range(20)])
    at, k = np.nonzero(all_x)
    w, b = toxicity.fit(at, k, kinds, label, pairs, l1=0.002, penalty=0.3, rounds=4000)
    w2, b2, _ = plain_solver(at, k, kinds, label, pairs, 0.002, 0.3)
    assert np.abs(w - w2).max() < 2e-3 and abs(b - b2) < 2e-3


def test_op13_swaps():
    ids = toxicity.Identities([["people", "women", "men", "girls"], ["person", "man"]])
    assert ids.swapped("The womenfolk and people", 3) == []
    assert ids.swapped("Women, men; man", 3) == ["people, people; person", "men, girls; man", "girls, women; man"]
    assert toxicity.Identities([]).swapped("women", 3) == []


def test_op13_awkward(spark):
    docs = frame(spark, ROWS, DOCS).withColumn("score", F.lit("x")).withColumn("toxic", F.lit("t")).withColumn("h", F.lit(1))
    labels = frame(spark, MARKS, LABELS)
    for marks in (labels, labels.where("false"), labels.where("toxic = 1"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        model = toxicity.train(docs, marks)
        got = toxicity.score(docs, model).collect()
        assert len(got) == len(ROWS) and all(0 < r["score"] < 1 for r in got)
        by_id = {r["doc_id"]: r["score"] for r in got}
        assert by_id[1] == by_id[2]
    assert toxicity.score(docs.where("false"), toxicity.train(docs.where("false"), labels)).count() == 0
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]


def test_op13_harm_is_found_in_a_very_long_text(spark):
    rows, marks = biased()
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"))
    clean = " ".join(f"plain{i % 200}" for i in range(300_000))
    new = spark.createDataFrame([(1, clean), (2, clean + " vile3"), (3, "vile3")], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(new, model).collect()}
    assert got == {1: 0, 2: 1, 3: 1}
