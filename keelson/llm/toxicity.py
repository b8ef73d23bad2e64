"""Toxicity: a counterfactual-regularised classifier.

A logistic model scores a text by the words, the words' beginnings (for inflected and
compound words) and the pairs of neighbouring words it holds (each counts once, so that harm
is found in long texts as in short ones). Mentions of groups of
people are frequent in toxic texts, so a plain model learns that the mention itself is
toxic. Therefore every labelled text that mentions a group is also taken with its identity
terms swapped: all terms of a list give way to the list's neutral word, and each to the
next ones of its list (``SWAPS`` in all). The fit penalises the squared change of the score
between a text and its swapped ones, ``PENALTY`` times their mean, so that what a text says
decides and not whom it mentions. The identity terms are a parameter; the defaults cover
four languages.

The model: 64-bit hashes of words (runs of ASCII letters and digits and of non-ASCII
characters, A-Z lower-cased), of beginnings and of word pairs, sorted, with their weights; a hash that is
not listed weighs nothing. There are no slots, so a long clean text meets no harmful word by
collision. Features are those whose share differs clearly between the classes (``MIN_Z``
standard errors, in at least ``MIN_DOCUMENTS`` texts); identity terms are always features,
or their weights could not be regularised. The fit is an accelerated proximal gradient with
an L1 penalty.

Bounds: the model is fitted on at most ``SAMPLE_ROWS`` labelled documents (the least hashes
of doc_id, without regard to the label), a documented bound. Which features tell is counted
on Spark (partial aggregation per feature), and only listed features of the sample come to
the driver: at most ``MAX_FEATURES``, the strongest. Every document is then scored, over its
whole text, by one pass of Arrow batches with the broadcast model.

Cases: a null text is empty; an empty text, or one without words, has the score of the
intercept alone; a label that is null, or whose doc_id is null or held out, is not learned;
several labels of one doc_id are toxic if any is; of several texts of one doc_id the least
is learned from; equal texts of the sample are learned once (toxic if any is); without
labels, or with labels of one class alone, every score is that share of toxic labels,
smoothed by one of each; a null doc_id is not held out; equal hashes of the sample are
ordered by doc_id, equally telling features by their hash; repeated rows are scored each;
a very long text is read whole, alone in its slice; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import text as T
from keelson.llm.common import cut, slices

SAMPLE_ROWS = 8_000
MAX_FEATURES = 20_000
MIN_Z = 5.0
MIN_DOCUMENTS = 4
L1 = 3e-5
STEMS = (5, 7)         # bytes of the words' beginnings that are features too
PENALTY = 1.0
SWAPS = 3
ROUNDS = 500
HOLD_OUT = 5           # documents whose crc32(doc_id) divides by it teach nothing
_PAIR = np.uint64(0xA24BAED4963EE407)
#: Identity terms by list, the neutral word first (a parameter of ``train``).
IDENTITIES = [
    ["people", "women", "men", "girls", "boys"],
    ["person", "woman", "man", "girl", "boy"],
    ["believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["straight", "gay", "lesbian", "bisexual", "transgender", "queer"],
    ["citizens", "immigrants", "refugees", "foreigners", "migrants"],
    ["local", "black", "white", "asian", "african", "arab", "latino", "european"],
    ["adults", "elderly", "disabled", "deaf", "blind"],
    ["menschen", "frauen", "männer", "juden", "muslime", "christen", "ausländer", "flüchtlinge", "schwule"],
    ["gens", "femmes", "hommes", "juifs", "musulmans", "chrétiens", "étrangers", "réfugiés", "homosexuels"],
    ["personas", "mujeres", "hombres", "judíos", "musulmanes", "cristianos", "extranjeros", "refugiados", "homosexuales"],
]


class Identities:
    """Finds and swaps identity terms."""

    def __init__(self, lists: list[list[str]]):
        self.place = {w.lower(): (k, i) for k, words in enumerate(lists) for i, w in enumerate(words)}
        self.lists = lists
        listed = sorted((w for words in lists for w in words[1:]), key=lambda w: (-len(w), w))
        self.found = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, listed)) + r")(?!\w)", re.IGNORECASE) if listed else None

    def swapped(self, text: str, swaps: int) -> list[str]:
        """``text`` with its terms neutralised, then with each moved on in its list;
        nothing if it has none."""
        if self.found is None or not self.found.search(text):
            return []

        def turn(by):
            def other(m):
                at = self.place.get(m.group().lower())
                if at is None:                     # a letter whose lower case is another one's
                    return m.group()
                words = self.lists[at[0]]
                return words[0] if by == 0 else words[1 + (at[1] - 1 + by) % (len(words) - 1)]
            return other
        return [self.found.sub(turn(by), text) for by in range(swaps)]


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, document) of every word, every beginning of a longer word and
    every pair of neighbours."""
    raw, offsets = T.arrow_bytes(column)
    words, first = T.batch_words(raw, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    inside = owner[1:] == owner[:-1]
    hashes, owners = [words, T.mix64(words[:-1] * _PAIR + words[1:])[inside]], [owner, owner[1:][inside]]
    for k in STEMS:
        stems = T.batch_words(raw, offsets, stem=k)[0]
        longer = stems != words
        hashes.append(T.mix64(stems[longer] + np.uint64(k)))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners)


class Scorer:
    """Sorted feature hashes, their weights and the intercept."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        used = np.flatnonzero(weights)
        order = used[np.argsort(hashes[used])]
        self.hashes, self.weights, self.intercept = hashes[order], weights[order], float(intercept)
        self.low = np.zeros(1 << 16, dtype=bool)   # most words are told by 16 bits
        self.low[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def scores(self, column) -> np.ndarray:
        hashes, docs = features(column)
        at = np.flatnonzero(self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        logit = np.full(len(column), self.intercept)
        if len(at):
            hashes, docs = hashes[at], docs[at]
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[place] == hashes
            both = np.unique(docs[hit] * np.int64(len(self.hashes)) + place[hit])      # each counts once
            logit += np.bincount(both // len(self.hashes), self.weights[both % len(self.hashes)], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def fit(rows: np.ndarray, kinds: np.ndarray, n_kinds: int, toxic: np.ndarray, pairs: np.ndarray, l1: float = L1,
        penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(weights, intercept) that minimise the mean log-loss of the texts with a label, plus
    ``l1`` times the sum of the weights' sizes, plus ``penalty`` times the mean of the
    squared score change over ``pairs`` (text, swapped text). ``rows`` and ``kinds`` are the
    texts and features of the set cells; ``toxic`` is 0, 1 or -1 for a swapped text."""
    n = len(toxic)
    named = toxic >= 0
    count, share = max(int(named.sum()), 1), (toxic[named].sum() + 1) / (named.sum() + 2)
    b = float(np.log(share / (1 - share)))
    w = np.zeros(n_kinds)
    if n_kinds == 0 or len(np.unique(toxic[named])) < 2:
        return w, b
    target = np.where(named, toxic, 0)
    left, right = (pairs[:, 0], pairs[:, 1]) if len(pairs) else (np.zeros(0, dtype=np.int64),) * 2

    def gradient(w, b):
        logit = np.bincount(rows, w[kinds], minlength=n) + b
        off = np.where(named, 1 / (1 + np.exp(-np.clip(logit, -60, 60))) - target, 0) / count
        slope = off.copy()
        if len(pairs):
            change = 2 * penalty * (logit[left] - logit[right]) / len(pairs)
            slope += np.bincount(left, change, minlength=n) - np.bincount(right, change, minlength=n)
        return np.bincount(kinds, slope[rows], minlength=n_kinds), off.sum()

    # per-feature bounds of the curvature: a text bounds its features by their number (and the intercept); of a pair
    # only the features that differ count, for which the two texts' cells are held against each other
    size = np.bincount(rows, minlength=n) + 1.0
    curve = np.bincount(kinds, (np.where(named, size, 0) / (4 * count))[rows], minlength=n_kinds)
    if len(pairs):
        cell = np.unique(rows * n_kinds + kinds)
        first = np.searchsorted(cell, np.arange(n + 1) * n_kinds)
        of = [cell[first[i]:first[i + 1]] % n_kinds for i in range(n)]
        for a, c in pairs:
            differ = np.setxor1d(of[a], of[c], assume_unique=True)
            curve[differ] += 2 * penalty * len(differ) / len(pairs)
    step, step_b = 1 / np.maximum(curve, 1e-9), 1 / max((size[named] / (4 * count)).sum(), 1e-9)
    ahead, ahead_b, t = w.copy(), b, 1.0
    for _ in range(rounds):
        g, g_b = gradient(ahead, ahead_b)
        new = ahead - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = ahead_b - step_b * g_b
        if ((ahead - new) * (new - w) / step).sum() + (ahead_b - new_b) * (new_b - b) / step_b > 0:
            t = 1.0                                # momentum points the wrong way: restart it
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, ahead_b = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    return w, b


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, distinct texts."""
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # bounded by the sample, hence fit to broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marks), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, identities: list[list[str]] = IDENTITIES, *, penalty: float = PENALTY,
          swaps: int = SWAPS, l1: float = L1, min_z: float = MIN_Z, min_documents: int = MIN_DOCUMENTS,
          sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES) -> Scorer:
    """Fit on the labelled rows that are not held out; ``labels`` is (doc_id, toxic)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Identities(identities))
    chosen = cut(sample(docs, labels, sample_rows))
    sizes = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def cells(batches):
        """The distinct features of each text."""
        for whole in batches:
            for b in slices(whole, 0):
                hashes, owner = features(b.column(0))
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                fresh = np.ones(len(hashes), dtype=bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                toxic = b.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(hashes[fresh].view(np.int64)), pa.array(toxic[owner[fresh]])], names=["h", "toxic"])

    counts = chosen.select("text", F.col("toxic").cast("int")).mapInArrow(cells, "h long, toxic int").groupBy("h").agg(
        F.count("*").cast("double").alias("n"), F.sum("toxic").cast("double").alias("t")).where(F.col("n") >= min_documents)
    n, share = float(n_toxic + n_clean), F.col("n") / F.lit(float(max(n_toxic + n_clean, 1)))
    gap = F.abs(F.col("t") / float(max(n_toxic, 1)) - (F.col("n") - F.col("t")) / float(max(n_clean, 1)))
    error = F.sqrt(share * (1 - share) * (1 / float(max(n_toxic, 1)) + 1 / float(max(n_clean, 1))))
    telling = counts.withColumn("z", gap / F.greatest(error, F.lit(1e-12))).where(F.col("z") >= min_z)
    told = [r["h"] for r in telling.orderBy(F.desc("z"), "h").limit(max_features).select("h").collect()] if n_toxic and n_clean else []
    words = sorted({w for words in identities for w in words})
    of_terms = features(pa.array(words, pa.string()))[0] if words else np.zeros(0, dtype=np.uint64)
    hashes = np.unique(np.concatenate([np.array(told, dtype=np.int64).view(np.uint64), of_terms]))
    listed = spark.sparkContext.broadcast(hashes)

    def held(batches):
        """Per text and swapped text: its listed features."""
        for whole in batches:
            for b in slices(whole, 0):
                for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    texts = [text, *shared.value.swapped(text, swaps)]
                    kinds = []
                    for t in texts:
                        h = np.unique(features(pa.array([t], pa.string()))[0])
                        kinds.append(np.flatnonzero(np.isin(listed.value, h, assume_unique=True)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([toxic], pa.int32()), pa.array([[k.tolist() for k in kinds]], pa.list_(pa.list_(pa.int32())))],
                                                     names=["toxic", "kinds"])
    got = chosen.select("text", F.col("toxic").cast("int")).mapInArrow(held, "toxic int, kinds array<array<int>>").toArrow()
    rows, kinds, toxic, pairs = [], [], [], []
    for label, versions in zip(got.column("toxic").to_pylist(), got.column("kinds").to_pylist()):
        at = len(toxic)
        for j, k in enumerate(versions):
            toxic.append(label if j == 0 else -1)
            rows.append(np.full(len(k), at + j))
            kinds.append(np.array(k, dtype=np.int64))
            if j:
                pairs.append((at, at + j))
    none = [np.zeros(0, dtype=np.int64)]
    weights, intercept = fit(np.concatenate(rows or none), np.concatenate(kinds or none), len(hashes), np.array(toxic, dtype=np.int64),
                             np.array(pairs, dtype=np.int64).reshape(len(pairs), 2), l1, penalty)
    return Scorer(hashes, weights, intercept)


def score(docs: DataFrame, model: Scorer) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text")
    id_type = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.scores(b.column(1)))], names=["doc_id", "score"])
    out = rows.mapInArrow(run, f"doc_id {id_type}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
