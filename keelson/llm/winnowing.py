"""Document fingerprints by winnowing.

Every text is hashed by a rolling polynomial over ``K``-grams of code points; in
every window of ``W`` consecutive hashes the least is chosen, the rightmost of
equal ones. A chosen hash is kept with its position, so two texts that share a
passage of ``W + K - 1`` (17) code points or more share a fingerprint entry whose
positions locate it (the match guarantee); a text of 34 or more keeps an entry
with its edit, which leaves half of it. There are about two entries per ``W + 1``
code points, so the string is about 3.5 times as long as its text. A text of fewer than ``K`` code points,
but not none, has one gram of all of them; fewer than ``W`` grams are one window.

The fingerprint string is a run of 16 hex digits per entry, in text order: 8 of
the hash and 8 of the position. The likeness of two fingerprints is the Jaccard
index of their hash sets (two empty ones: 1).

``edited_pairs`` needs each document's successor in descending doc_id. Rows are
dealt to doc_id ranges (bounds from quantiles), the first row of each range is
also sent to the range before it, and each range is sorted and read once as a
stream. Every text is shuffled once; no range, list or text of all documents
stands in one task.

Cases: a null text is empty (fingerprint ''); a null doc_id comes after all
others; rows that share a doc_id stand in the order of their texts, and the ones
equal in both are interchangeable; after the last row comes the first (a single
row follows itself); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import partitions, text_or_empty
from keelson.llm.text import mix64

K = 10
W = 8
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """32-bit hashes of the k-grams of code points, by doubling: the hash of
    2**i code points is that of its halves, and k is a sum of such runs."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(codes)
    if n == 0:
        return np.zeros(0, dtype=np.uint32)
    k = min(k, n)
    out, done = None, 0
    run, width, power = codes + np.uint64(1), 1, _BASE
    left = k
    while left:
        if left & 1:
            if out is None:
                out, done = run, width
            else:
                m = n - done - width + 1
                out = out[:m] * np.uint64(power) + run[done:done + m]
                done += width
        left >>= 1
        if left:
            run = run[:-width] * np.uint64(power) + run[width:]
            width, power = width * 2, power * power & _MASK
    return (mix64(out[:n - k + 1]) >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(chosen hashes, their positions): the rightmost least hash per window,
    found by doubling the window over (value, position) arrays."""
    n = len(hashes)
    if n == 0:
        return hashes, np.zeros(0, dtype=np.uint32)
    w = min(w, n)
    # one key per position: hash above, reversed position below, so that the least
    # key is the least hash and, among equal hashes, the rightmost
    key = (hashes.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    width = 1
    while width * 2 <= w:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < w:
        rest = w - width
        key = np.minimum(key[:-rest], key[rest:])
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = key[1:] != key[:-1]
    key = key[keep]
    at = np.uint64(0xFFFFFFFF) - (key & np.uint64(0xFFFFFFFF))
    return (key >> np.uint64(32)).astype(np.uint32), at.astype(np.uint32)


def fingerprint(text: str, k: int = K, w: int = W) -> tuple[str, np.ndarray]:
    """(fingerprint string, sorted distinct hashes)."""
    h, at = winnow(gram_hashes(text, k), w)
    both = np.empty((len(h), 2), dtype=">u4")
    both[:, 0], both[:, 1] = h, at
    return both.tobytes().hex(), np.unique(h)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 and len(b) == 0:
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, *, k: int = K, w: int = W) -> DataFrame:
    """doc_id and the fingerprint of its whole text, for every row."""
    def run(batches):
        for b in batches:
            prints = [fingerprint(t.as_py() or "", k, w)[0] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def _edited(k: int, w: int):
    def rows(batches):
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist())

    def run(batches):
        out: list[tuple] = []
        size = 0
        prev = None
        for part, scalar, doc_id, guest in rows(batches):
            text = scalar.as_py()
            shown, hashes = fingerprint(text, k, w)
            if prev is not None and prev[0] == part:
                _, p_text, p_id, p_shown, p_hashes = prev
                n = len(p_text)
                edited = p_text[:n - n // 2] + text[:n // 2]
                e_shown, e_hashes = (p_shown, p_hashes) if edited == p_text else fingerprint(edited, k, w)
                out.append((p_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), p_shown, e_shown,
                            likeness(p_hashes, e_hashes), likeness(p_hashes, hashes)))
                size += len(p_shown) + len(e_shown)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [], 0
            prev = None if guest else (part, text, doc_id, shown, hashes)
        if out:
            yield _batch(out)
    return run


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _bounds_up_to(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``value``: the group of bounds
    first, then the place in it (work with the root of their number)."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    longs = [F.array(*[F.lit(b).cast("long") for b in g]) for g in groups]
    group = F.size(F.filter(F.array(*[F.lit(g[0]).cast("long") for g in groups]), lambda b: b <= value))
    inside = F.size(F.filter(F.element_at(F.array(*longs), F.greatest(group, F.lit(1))), lambda b: b <= value))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * width + inside)


def edited_pairs(docs: DataFrame, *, k: int = K, w: int = W, ranges_per_partition: int = 4) -> DataFrame:
    """Fingerprint of every text and of its edited text (the last half of its
    code points replaced by the first as many of the next document in descending
    doc_id), with their likeness and the likeness to the next document."""
    spark = docs.sparkSession
    n = partitions(spark) * ranges_per_partition
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # bounded: one number per range, whatever the table's size
    marks = [i / n for i in range(1, n)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", marks, 100 * n)).first()[0] or []))
    # range 0 holds the greatest ids; nulls come last
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.lit(len(bounds)) - _bounds_up_to(F.col("doc_id"), bounds)).cast("int")
    rows = rows.withColumn("part", part)
    # the first row of each range that has one: its greatest id, then the least text
    top = rows.groupBy("part").agg(F.max("doc_id").alias("top"))
    tops = {r["part"]: r["top"] for r in top.collect()}
    order = sorted(tops)
    if not order:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                 "edited_fingerprint string, near_edited double, near_next double")
    before = {p: order[i - 1] for i, p in enumerate(order)}       # the first range follows the last
    ids = [t for t in tops.values() if t is not None]
    is_top = F.col("doc_id").isin(ids) if ids else F.lit(False)
    if None in tops.values():
        is_top = is_top | F.col("doc_id").isNull()
    to = F.element_at(F.create_map(*[F.lit(x) for p, q in before.items() for x in (p, q)]), F.col("part"))
    guests = rows.where(is_top).groupBy("part").agg(F.min("text").alias("text")).select(
        to.alias("part"), "text", F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("guest"))
    dealt = rows.select("part", "text", "doc_id", F.lit(False).alias("guest")).unionByName(guests)
    dealt = dealt.repartition("part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.mapInArrow(_edited(k, w), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                            "edited_fingerprint string, near_edited double, near_next double")
