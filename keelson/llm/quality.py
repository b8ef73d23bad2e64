"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are grades 0..G-1. One weight vector over hashed text features is shared
by all grades; ordered thresholds t1 < t2 < ... cut its score:
``P(grade <= k) = sigmoid(t_{k+1} - w.x)``. That gives the expected grade and the
tail probability ``P(grade >= k)`` by which documents are selected.

Features are hashed into ``DIMENSIONS`` slots: every word, the words' beginnings and
every run of punctuation, each valued by the root of its occurrences per word (so a
long text weighs as much as a short one), and the tenths of the shares of capitals,
of punctuation and of distinct words. They are taken from the whole text, bytes of a
batch at a time. Only features whose share differs clearly between grades
are fitted (``MIN_Z``), by an accelerated proximal gradient with an L1 penalty, so
words that say nothing have weight 0 and a long clean text does not gather noise.

The weights are fitted on at most ``SAMPLE_ROWS`` rated documents (the least hashes
of doc_id), a documented bound; every document is then scored. The grades of the
tables here: 0 for toxic, 1 for low quality, 2 for good. (Toxic is lowest as harm words
add up in a long text; as a middle grade, they would have to stop half-way.)

Cases: a text that is null or has no word has nothing to grade: expected grade 0
and tail 0; a rating with a null grade or doc_id is not used; of several ratings
of one doc_id the least counts, and of several texts the least; without ratings, or of one grade alone, that grade
(else the highest) is given to every text; of equal hashes in the sample the least doc_id
comes first; a very long text is read whole, by one task; repeated documents are scored
each; an empty ``documents`` table gives no rows; other columns are ignored (``select`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import text as T
from keelson.llm.common import slices

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 8_000
MIN_Z = 5.0
MIN_DOCUMENTS = 8
MAX_FEATURES = 4_000
L1 = 1e-5
ROUNDS = 400
MIN_TAIL = 0.3
STEMS = (5, 7)         # bytes of the words' beginnings that are features too
SHARES = 64            # slots kept for the shares
_SIGNS = np.zeros(256, dtype=np.uint8)
for _c in range(0x21, 0x7F):
    if not (0x30 <= _c <= 0x39 or 0x41 <= _c <= 0x5A or 0x61 <= _c <= 0x7A):
        _SIGNS[_c] = _c


def _slots(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (T.mix64(hashes ^ np.uint64(salt)) % np.uint64(DIMENSIONS - SHARES)).astype(np.int64) + SHARES


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Tenths of part / whole, 10 for all of it; -1 where there is nothing."""
    return np.where(whole > 0, (10 * part) // np.maximum(whole, 1), -1).astype(np.int64)


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, the document of each slot, words of each document); a slot stands
    once per occurrence. The shares' slots are below ``SHARES``, text slots above."""
    raw, offsets = T.arrow_bytes(column)
    n = len(offsets) - 1
    words, first = T.batch_words(raw, offsets)
    signs, s_first = T.batch_words(raw, offsets, _SIGNS)
    n_words = np.diff(first)

    def per_doc(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    upper = per_doc((raw >= 0x41) & (raw <= 0x5A))
    letters = upper + per_doc((raw >= 0x61) & (raw <= 0x7A) | (raw >= 0xC0))
    sign_bytes = per_doc(_SIGNS[raw] != 0)
    owner = np.repeat(np.arange(n), n_words)
    order = np.lexsort((words, owner)) if len(words) else np.zeros(0, dtype=np.int64)
    w, o = words[order], owner[order]
    fresh = np.ones(len(w), dtype=bool)
    fresh[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[fresh], minlength=n)
    shares = np.stack([_share(upper, letters) + 1, _share(sign_bytes, np.diff(offsets)) + 13,
                       np.where(n_words >= 20, _share(distinct, n_words), -1) + 25], axis=1).ravel()
    stems = [_slots(T.batch_words(raw, offsets, stem=k)[0], 0x1000 + k) for k in STEMS]
    slots = np.concatenate([_slots(words, 0), *stems, _slots(signs, 0x5151), shares])
    docs = np.concatenate([owner, *[owner] * len(STEMS), np.repeat(np.arange(n), np.diff(s_first)), np.repeat(np.arange(n), 3)])
    return slots, docs, n_words


def _values(slots: np.ndarray, docs: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs, by document, and their values: 1 for the
    shares, the root of occurrences per word for the rest."""
    both, count = np.unique(docs * DIMENSIONS + slots, return_counts=True)
    slots, docs = both % DIMENSIONS, both // DIMENSIONS
    value = np.where(slots < SHARES, 1.0, np.sqrt(count / np.maximum(n_words[docs], 1)))
    return slots, docs, value


class Ordinal:
    """Weights, thresholds and the grades they tell apart."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(P(grade >= k) for k = 1.., has words) of a batch of texts."""
        slots, docs, n_words = features(column)
        at = np.flatnonzero(self.weights[slots])
        slots, docs, value = _values(slots[at], docs[at], n_words)
        score = np.bincount(docs, self.weights[slots] * value, minlength=len(n_words))
        out = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))
        out[n_words == 0] = 0
        return out, n_words > 0


def _telling(slots, value, owner, grades, n_grades: int) -> np.ndarray:
    """The slots whose mean value differs between the documents below and above some
    threshold by ``MIN_Z`` standard errors, the strongest ``MAX_FEATURES``."""
    n = len(grades)
    total = np.bincount(slots, value, minlength=DIMENSIONS)
    spread = np.sqrt(np.maximum(np.bincount(slots, value * value, minlength=DIMENSIONS) / n - (total / n) ** 2, 1e-12))
    best = np.zeros(DIMENSIONS)
    for k in range(n_grades - 1):
        low = grades <= k
        n_low = int(low.sum())
        if 0 < n_low < n:
            mine = low[owner]
            in_low = np.bincount(slots[mine], value[mine], minlength=DIMENSIONS)
            gap = in_low / n_low - (total - in_low) / (n - n_low)
            best = np.maximum(best, np.abs(gap) / (spread * np.sqrt(1 / n_low + 1 / (n - n_low))))
    best[np.bincount(slots, minlength=DIMENSIONS) < MIN_DOCUMENTS] = 0
    order = np.argsort(-best, kind="stable")[:MAX_FEATURES]
    return np.sort(order[best[order] >= MIN_Z])


def fit(slots: np.ndarray, value: np.ndarray, first: np.ndarray, grades: np.ndarray, n_grades: int, l1: float = L1, rounds: int = ROUNDS) -> Ordinal:
    """Accelerated proximal gradient on the mean log-likelihood with an L1 penalty;
    each weight steps by a bound of its own curvature."""
    n = len(grades)
    counts = np.bincount(grades, minlength=n_grades)
    if n == 0 or (counts > 0).sum() < 2:           # nothing to tell apart
        top = int(grades[0]) if n else n_grades - 1
        return Ordinal(np.zeros(DIMENSIONS), np.where(np.arange(1, n_grades) <= top, -60.0, 60.0))
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(first))
    kinds = _telling(slots, value, owner, grades, n_grades)
    place = np.full(DIMENSIONS, -1, dtype=np.int32)
    place[kinds] = np.arange(len(kinds))
    slot = place[slots]
    slot, owner, value = slot[slot >= 0], owner[slot >= 0], value[slot >= 0].astype(np.float64)
    share = np.clip(np.cumsum(counts)[:-1] / n, 1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(n_grades - 1) * 1e-3)
    row = np.bincount(owner, value, minlength=n) + 1.0
    step = 1 / np.maximum(np.bincount(slot, value * row[owner], minlength=len(kinds)) / (2 * n), 1e-9)
    w, ahead, t = np.zeros(len(kinds)), np.zeros(len(kinds)), 1.0

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for _ in range(rounds):
        score = np.bincount(owner, ahead[slot] * value, minlength=n)
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        low, high = sigmoid(cut[grades] - score), sigmoid(cut[grades + 1] - score)
        low[grades == 0], high[grades == n_grades - 1] = 0, 1
        p = np.maximum(high - low, 1e-9)
        g = -np.bincount(slot, (low + high - 1)[owner] * value, minlength=len(kinds)) / n
        gt = np.zeros(len(theta))
        for k in range(len(theta)):
            gt[k] = -((high * (1 - high) / p)[grades == k].sum() - (low * (1 - low) / p)[grades == k + 1].sum()) / n
        new = ahead - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        if ((ahead - new) * (new - w)).sum() > 0:  # momentum points the wrong way: restart it
            t = 1.0
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / after * (new - w)
        w, t = new, after
        theta = np.maximum.accumulate(theta - gt + np.arange(len(theta)) * 1e-9)
    weights = np.zeros(DIMENSIONS)
    weights[kinds] = w
    return Ordinal(weights, theta)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """Fit on at most ``sample_rows`` rated documents; ``ratings`` is (doc_id, grade)."""
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    # ratings of absent documents would use up the bound
    rated = rated.join(docs.select("doc_id"), "doc_id", "left_semi")
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # bounded by sample_rows, hence fit to broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("text").alias("text")).select("grade", "text")

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                slots, owner, n_words = features(b.column(1))
                slots, owner, value = _values(slots, owner, n_words)
                first = pa.array(np.searchsorted(owner, np.arange(len(n_words) + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int32()), pa.ListArray.from_arrays(first, pa.array(slots, pa.int32())),
                     pa.ListArray.from_arrays(first, pa.array(value, pa.float32()))], names=["grade", "slots", "value"])
                yield out.filter(pa.array(n_words > 0))
    got = rows.mapInArrow(run, "grade int, slots array<int>, value array<float>").toArrow()
    if got.num_rows == 0:
        none = np.zeros(0, dtype=np.int64)
        return fit(none, none, np.zeros(1, dtype=np.int64), none, n_grades)
    lists, value = pa.concat_arrays(got.column("slots").chunks), pa.concat_arrays(got.column("value").chunks)
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    return fit(lists.flatten().to_numpy(), value.flatten().to_numpy(), first, got.column("grade").to_numpy().astype(np.int64), n_grades)


def _scored(docs: DataFrame, model: Ordinal, extra: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*extra, "text") if "text" not in extra else docs.select(*extra)
    at = rows.columns.index("text")
    keep = [rows.columns.index(c) for c in extra]
    fields = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in extra)

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                tails, has = shared.value.tails(b.column(at))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                    names=[*extra, "_expected", "_tails"])
    return rows.mapInArrow(run, f"{fields}, _expected double, _tails array<double>")


def grade(docs: DataFrame, model: Ordinal, min_tail: float = MIN_TAIL) -> DataFrame:
    """Per document: doc_id, expected_grade, tail_prob (of the highest grade), keep."""
    out = _scored(docs, model, ["doc_id"])
    top = F.element_at("_tails", -1)
    return out.select("doc_id", F.col("_expected").alias("expected_grade"), top.alias("tail_prob"), (top >= min_tail).alias("keep"))


def select(docs: DataFrame, model: Ordinal, min_tail: float = MIN_TAIL) -> DataFrame:
    """The documents whose highest grade has a tail probability of ``min_tail`` or more; all columns."""
    return _scored(docs, model, docs.columns).where(F.element_at("_tails", -1) >= min_tail).select(*[f"`{c}`" for c in docs.columns])


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings of the labels table: 0 toxic (whatever the quality), 1 low quality, 2 good."""
    good: Column = F.col("quality") > 0
    toxic: Column = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    return labels.where(toxic | F.col("quality").isNotNull()).select(
        "doc_id", F.when(toxic, 0).when(good, 2).otherwise(1).cast("int").alias("grade"))
