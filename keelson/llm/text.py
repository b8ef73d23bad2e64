"""Vectorised word and shingle hashing over an Arrow batch of texts.

A batch's UTF-8 bytes are handled as one array, so the cost per document is a
few array operations and no Python loop runs over words. A word is a maximal
run of ASCII letters and digits and of non-ASCII characters; A-Z are lower-cased
(the byte rule ``[0-9a-z\\x80-\\xff]+``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _fold_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)          # 0: not part of a word
    for c in range(256):
        if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80:
            table[c] = c
        elif 0x41 <= c <= 0x5A:
            table[c] = c + 0x20
    return table


_FOLD = _fold_table()
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2**64) for i < n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inv = pow(int(_BASE), -1, 1 << 64)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, np.uint64(inv), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"] = np.multiply.accumulate(up)
        _POWERS["down"] = np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public murmur3 constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return raw[first:last], offsets - first


def batch_words(raw: np.ndarray, offsets: np.ndarray, fold: np.ndarray = _FOLD, stem: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of every document + end). ``fold``
    maps a byte to its normal form; 0 stands between words. With ``stem``, hashes
    are of the words' first so many bytes (a shorter word's is of the whole)."""
    n_docs = len(offsets) - 1
    if len(raw) == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(n_docs + 1, dtype=np.int64)
    folded = fold[raw]
    inside = folded != 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(raw)]
    begin[cuts] = inside[cuts]                     # a word never spans two documents
    starts = np.flatnonzero(begin)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(n_docs + 1, dtype=np.int64)
    count = np.add.accumulate(inside, dtype=np.int64)
    # word length = inside bytes from this start to the next one
    before = count[starts] - 1
    lengths = np.diff(np.append(before, count[-1]))
    if stem is not None:
        lengths = np.minimum(lengths, stem)
    up, down = _powers(len(raw) + 1)
    prefix = np.empty(len(raw) + 1, dtype=np.uint64)
    prefix[0] = 0
    np.cumsum(folded * up[:len(raw)], out=prefix[1:])
    words = (prefix[starts + lengths] - prefix[starts]) * down[starts]
    words = mix64(words + lengths.astype(np.uint64) * _STEP)
    return words, np.searchsorted(starts, offsets).astype(np.int64)


def batch_shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every ``size``-word shingle, first shingle of every
    document + end). A document of fewer words, but not none, has one shingle
    made of all of them."""
    counts = np.diff(first)
    n_sh = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(n_sh)]).astype(np.int64)
    total = int(out_first[-1])
    if total == 0:
        return np.zeros(0, dtype=np.uint64), out_first
    doc = np.repeat(np.arange(len(counts)), n_sh)
    at = first[:-1][doc] + (np.arange(total) - out_first[:-1][doc])
    left = np.minimum(size, counts)[doc]
    acc = np.zeros(total, dtype=np.uint64)
    top = len(words) - 1
    for j in range(size):
        acc *= _STEP
        word = words[np.minimum(at + j, top)]
        acc += np.where(j < left, word, np.uint64(0))
    return mix64(acc + left.astype(np.uint64)), out_first
