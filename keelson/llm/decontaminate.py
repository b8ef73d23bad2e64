"""Benchmark decontamination by a generalised suffix automaton.

The normalised words of all benchmark items are put into one suffix automaton
over word ids (items separated by restarting at the root). A document's words are
streamed through it; the state gives, at each word, the length of the longest run
ending there that occurs in some item. Every run of at least ``WINDOW`` words is a
span; an item of fewer words, but not none, counts where the whole of it occurs.
Words of a span are hit. The items of a span are those that hold one of its
windows.

Normalisation: A-Z are lower-cased; a word is a run of ASCII letters and digits
and of non-ASCII characters.

Items are dealt to blocks of about ``BLOCK_WORDS`` words by a running count of their words.
Each block's automaton is built in a Spark task and written to the shared checkpoint folder;
the blocks are then taken one at a time, each broadcast for one pass over the documents, so
neither the driver nor a worker ever holds more than one block, however large the
benchmark. The spans of several blocks are joined per document (only documents with spans
are shuffled for it); with one block nothing is shuffled.

Cases: a null or wordless text has no words and is clean; a null or wordless item
occurs nowhere; a null item_id is the empty id; repeated items (same item_id) count once per
item_id; an item of more than a block's words is a block of its own; repeated documents get a
row each; a very long text is streamed whole by one task; extra columns are ignored
(``decontaminate`` keeps them); an empty benchmark leaves every document clean; an empty
``documents`` table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut, scratch
from keelson.operators.scan import running

WINDOW = 10
BLOCK_WORDS = 200_000  # an automaton of some 100 MB in a worker
PART_BYTES = 16 << 20  # of a block's automaton in a row
MAX_COVERAGE = 0.5
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return _WORD.findall(raw.lower())              # bytes.lower() changes A-Z alone


class SuffixAutomaton:
    """Generalised suffix automaton over the word ids of the items."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q whose longest run is one longer than p's."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:                          # the run stands in an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, ids: list[int]) -> None:
        last = 0
        for c in ids:
            last = self.extend(last, c)


class Index:
    """A block's automaton with the items of every window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        automaton = SuffixAutomaton()
        self.items: dict[tuple, set[str]] = {}     # window (its words' ids) -> item ids
        short = set()
        for item_id, words in items:
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            automaton.add(ids)
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1):
                self.items.setdefault(tuple(ids[i:i + n]), set()).add(item_id)
            if len(ids) < window:
                short.add(len(ids))
        self.short = sorted(short)
        self.least = min([window, *short])         # shorter runs can't be a window
        self.next, self.link, self.length = automaton.next, automaton.link, automaton.length

    def packed(self) -> bytes:
        return pickle.dumps(vars(self), protocol=4)

    @classmethod
    def unpacked(cls, data: bytes) -> Index:
        out = cls([])
        vars(out).update(pickle.loads(data))
        return out

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(spans [start, end) of hit words, merged; ids of the items found)."""
        ids = list(map(self.vocabulary.get, words))
        nxt, link, length, least, window = self.next, self.link, self.length, self.least, self.window
        root = nxt[0]
        spans: list[list[int]] = []
        found: set[str] = set()
        state = run = 0
        for i, c in enumerate(ids):
            if c is None:
                state = run = 0
                continue
            to = nxt[state].get(c)
            if to is not None:
                state = to
                run += 1
            else:
                while True:
                    state = link[state]
                    if state < 0:
                        state = run = 0
                        break
                    to = nxt[state].get(c)
                    if to is not None:
                        run = length[state] + 1
                        state = to
                        break
            if run < least:
                continue
            start = None
            if run >= window:
                found |= self.items[tuple(ids[i + 1 - window:i + 1])]
                start = i + 1 - run
            for n in self.short:
                if n <= run and (ending := self.items.get(tuple(ids[i + 1 - n:i + 1]))):
                    found |= ending
                    start = i + 1 - n if start is None else min(start, i + 1 - n)
            if start is not None:
                while spans and spans[-1][1] >= start and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])
        return [(a, b) for a, b in spans], found


def _built(benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(table of the blocks' automata as (block, part, data), number of blocks)."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text is not null").distinct()
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), F.lit(0)))
    rows = running(rows, [], ["item_id", "text"], upto=("sum", words.cast("long")))
    rows = cut(rows.select("item_id", "text", F.expr(f"cast((upto - 1) div {block_words} as int)").alias("block")).where("block >= 0"))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        data = Index([(i, words_of(t)) for i, t in zip(pdf["item_id"], pdf["text"])], window).packed()
        parts = [data[at:at + PART_BYTES] for at in range(0, len(data), PART_BYTES)]
        return pd.DataFrame({"block": [int(key[0])] * len(parts), "part": range(len(parts)), "data": parts})
    path = f"{scratch(benchmark.sparkSession)}/automata-{uuid.uuid4().hex}"
    rows.groupBy("block").applyInPandas(build, "block int, part int, data binary").write.parquet(path)
    table = benchmark.sparkSession.read.schema("block int, part int, data binary").parquet(path)
    return table, rows.select("block").distinct().count()


def _passes(benchmark: DataFrame, window: int, block_words: int):
    """The number of blocks, and the blocks' automata one at a time, each broadcast until the next is asked for."""
    table, n = _built(benchmark, window, block_words)
    sc = benchmark.sparkSession.sparkContext

    def blocks():
        for k in [r[0] for r in table.select("block").distinct().orderBy("block").collect()]:
            data = b"".join(bytes(r["data"]) for r in table.where(F.col("block") == k).orderBy("part").collect())
            shared = sc.broadcast(Index.unpacked(data))
            yield shared
            shared.unpersist()
    return n, blocks


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _row_key() -> Column:
    """Rows equal in doc_id and text are judged alike."""
    return F.struct("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h"))


_FOUND = "array<struct<a:int,b:int>>"


def _hits(docs: DataFrame, blocks) -> DataFrame:
    """(k, spans, items) per text (``docs``: k, text) with spans, merged over all blocks: one
    pass per block, each written before the next begins."""
    texts, parts = docs.where("text is not null").dropDuplicates(["k"]), None
    kind = texts.schema["k"].dataType.simpleString()
    for shared in blocks():
        def run(batches, shared=shared):
            for b in batches:
                at, spans, items = [], [], []
                for i, text in enumerate(b.column(1).cast(pa.large_binary())):
                    s, f = shared.value.matches(words_of(text.as_py()))
                    if s:
                        at.append(i)
                        spans.append([{"a": x, "b": y} for x, y in s])
                        items.append(sorted(f))
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at, pa.int64())), pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                         pa.array(items, pa.list_(pa.string()))], names=["k", "spans", "items"])
        part = cut(texts.select("k", "text").mapInArrow(run, f"k {kind}, spans {_FOUND}, items array<string>"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


_OUT = [("n_words", pa.int64(), "long"), ("n_hit", pa.int64(), "long"), ("n_items", pa.int64(), "long"), ("items_sha256", pa.string(), "string"),
        ("contaminated", pa.bool_(), "boolean"), ("longest", pa.int64(), "long"), ("coverage", pa.float64(), "double")]


def _row(n: int, spans: list, items) -> tuple:
    hit = sum(e - s for s, e in spans)
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n, hit, len(items), digest, hit > 0, max((e - s for s, e in spans), default=0), hit / n if n else 0.0


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    longest (the longest span's words) and coverage (hit share of the words)."""
    n_blocks, blocks = _passes(benchmark, window, block_words)
    rows = docs.select("doc_id", "text")
    shared: Broadcast | None = next(blocks()) if n_blocks == 1 else None
    if n_blocks > 1:
        hits = _hits(rows.select(_row_key().alias("k"), "text"), blocks)
        # null-safe, as a doc_id may be null
        rows = rows.withColumn("_k", _row_key()).join(hits, F.col("_k").eqNullSafe(F.col("k")), "left").select("doc_id", "text", "spans", "items")

    def run(batches):
        for b in batches:
            out = []
            texts = b.column(1).cast(pa.large_binary())
            for i in range(b.num_rows):
                words = words_of(texts[i].as_py())
                if shared is not None:
                    spans, items = shared.value.matches(words)
                elif n_blocks > 1 and b.column(2)[i].is_valid:
                    spans, items = _merged([(s["a"], s["b"]) for s in b.column(2)[i].as_py()]), b.column(3)[i].as_py()
                else:
                    spans, items = [], []
                out.append(_row(len(words), spans, items))
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, (_, k, _) in zip(zip(*out), _OUT))],
                                                 names=["doc_id", *[name for name, _, _ in _OUT]])
    fields = ", ".join(f"{name} {sql}" for name, _, sql in _OUT)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {fields}")


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw.lower())]
    keep, pos = [], 0
    for a, b in spans:
        keep.append(raw[pos:at[a][0]])
        pos = at[b - 1][1]
    keep.append(raw[pos:])
    return b"".join(keep).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every span of ``window`` or more words of an item removed
    from its text; a document of which more than ``max_coverage`` is hit is
    dropped. All columns are kept; ``n_chars``, if there, follows the text."""
    n_blocks, blocks = _passes(benchmark, window, block_words)
    if n_blocks == 0:
        return docs
    out = _cleaned(docs, next(blocks()), max_coverage) if n_blocks == 1 else _cleaned_by_blocks(docs, blocks, max_coverage)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def _cleaned(docs: DataFrame, shared: Broadcast, max_coverage: float) -> DataFrame:
    at = docs.columns.index("text")

    def one(value: str):
        words = words_of(value)
        return len(words), shared.value.matches(words)[0]

    def run(batches):
        for b in batches:
            texts, keep, changed = [], [], False
            for text in b.column(at):
                value = text.as_py()
                n, spans = one(value) if value else (0, [])
                hit = sum(e - s for s, e in spans)
                keep.append(not hit or hit <= max_coverage * n)
                changed |= hit > 0
                while spans and keep[-1]:          # what a removal brings together can match anew
                    value = _without(value, spans)
                    spans = one(value)[1]
                texts.append(value)
            if changed:
                columns = [pa.array(texts, b.schema.field(at).type) if i == at else c for i, c in enumerate(b.columns)]
                b = pa.RecordBatch.from_arrays(columns, schema=b.schema).filter(pa.array(keep, pa.bool_()))
            if b.num_rows:
                yield b
    return docs.mapInArrow(run, docs.schema)


def _cleaned_by_blocks(docs: DataFrame, blocks, max_coverage: float) -> DataFrame:
    """``_cleaned`` with one block held at a time: rounds of passes over the texts that the
    last round changed, until none has a span."""
    names = [f"`{c}`" for c in docs.columns]
    todo, done, first = docs, None, True
    while True:
        hits = cut(_hits(todo.select(_row_key().alias("k"), "text"), blocks).select("k", "spans"))
        rows = todo.withColumn("_k", _row_key()).join(hits, F.col("_k").eqNullSafe(F.col("k")), "left")
        clean = rows.where("spans is null").select(*names)
        done = clean if done is None else done.unionByName(clean)
        if hits.isEmpty():
            return done
        limit = max_coverage if first else None
        at = docs.columns.index("text")

        def run(batches, limit=limit, at=at):
            for b in batches:
                texts, keep = [], []
                for text, found in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                    spans = _merged([(s["a"], s["b"]) for s in found])
                    keep.append(limit is None or sum(y - x for x, y in spans) <= limit * len(words_of(text)))
                    texts.append(_without(text, spans) if keep[-1] else text)
                columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(b.columns[:-1])]
                yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))
        todo, first = cut(rows.where("spans is not null").select(*names, "spans").mapInArrow(run, docs.schema)), False
