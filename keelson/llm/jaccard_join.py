"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Method. Every text becomes its set of word shingles (five words; a text of
fewer words has one shingle of all of them). Equal word sequences form a *class*
and are compared once. A class has a signature of ``trees * depth`` one-byte
MinHash values; each tree's label is its run of ``depth`` values, and sorting
labels gives the tree's prefix trie. The forest is descended from full labels to
shorter prefixes: a round at prefix length p gathers the classes under one trie
node; the rounds stop at the longest p whose recall for a pair at the threshold,
``1 - (1 - threshold**p)**trees``, reaches ``target_recall``. In a round, classes
of one node whose signatures agree are joined by spanning edges only. A class whose
signature equals that of another class of its node is absorbed by it: whatever meets
the one at a shorter prefix meets the other there with the same agreement, so nothing
is lost, and shorter prefixes do not meet a large group of copies again.

Verification is exact. The classes of one candidate component are compared by
their shingle sets in blocks of bounded size (all block pairs of a component, as
a matrix product inside the task), so every link at or above the threshold
between two classes of a component is found and counted, and no list of pairs is
ever written. Final groups are the components of the verified links.

Cases: a null text or one without a word has no shingle, no link and its own
class id; a null doc_id is an id like any other; repeated rows are copies of one
class (a link each); the order of rows never matters; columns besides doc_id and
text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from keelson.llm import text as T
from keelson.llm.common import components, cut, slices

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 8
TARGET_RECALL = 0.999
BLOCK = 512            # classes of one comparison block
BLOCK_SHINGLES = 1 << 19


def recall_at(prefix: int, similarity: float = THRESHOLD, trees: int = TREES) -> float:
    """Probability that a pair of this similarity shares a prefix in a tree."""
    return 1.0 - (1.0 - similarity ** prefix) ** trees


def prefix_schedule(threshold=THRESHOLD, trees=TREES, depth=DEPTH, target=TARGET_RECALL) -> list[int]:
    """Full labels first, then the longest prefix that reaches the target."""
    last = next((p for p in range(depth, 0, -1) if recall_at(p, threshold, trees) >= target), 1)
    return [depth, last] if last < depth else [depth]


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = T.mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:n] | np.uint64(1)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


def signatures(shingles: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """(documents, n) one-byte MinHash values; zeros without shingles."""
    counts = np.diff(first)
    out = np.zeros((len(counts), n), dtype=np.uint8)
    some = np.flatnonzero(counts)
    if len(some) == 0:
        return out
    starts = first[:-1][some]
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    mul, add = _multipliers(n)
    work = np.empty_like(low)
    for j in range(n):
        np.multiply(low, mul[j], out=work)
        np.add(work, add[j], out=work)
        least = np.minimum.reduceat(work, starts)
        out[some, j] = (least * np.uint32(2654435761)) >> np.uint32(24)
    return out


def _class_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16-byte key of every document's word sequence."""
    counts = np.diff(first)
    at = np.arange(len(words), dtype=np.uint64) - np.repeat(first[:-1], counts).astype(np.uint64)
    out = np.zeros((len(counts), 2), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = first[:-1][some]
        for side, seed in ((0, 0xA24BAED4963EE407), (1, 0x9FB21C651E98DF25)):
            term = T.mix64(words + (at + np.uint64(1)) * np.uint64(seed))
            out[some, side] = T.mix64(np.add.reduceat(term, starts) + counts[some].astype(np.uint64))
    return out


def _sketch(shingle: int, n: int):
    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                words, first = T.batch_words(*T.arrow_bytes(b.column(1)))
                sh, sh_first = T.batch_shingles(words, first, shingle)
                sig = signatures(sh, sh_first, n)
                keys = _class_keys(words, first)
                n_sh = np.diff(sh_first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(n_sh, pa.int64()),
                     pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc_id", "key", "n_shingles", "sig"])
    return run


def _whole_units(batches):
    """Tables of complete units; rows arrive sorted by their first column, the unit."""
    held = []
    for b in batches:
        if b.num_rows == 0:
            continue
        unit = b.column(0).to_numpy()
        if held and held[-1].column(0)[0].as_py() != unit[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.searchsorted(unit, unit[-1], side="left"))
        if last:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of every node's component under the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _span(n_values: int, agree: int):
    """Spanning edges among the classes of a unit whose signatures agree."""
    def run(batches):
        for t in _whole_units(batches):
            unit, keys = t.column(0).to_numpy(), t.column(1).to_pylist()
            sig = np.frombuffer(b"".join(t.column(2).to_pylist()), dtype=np.uint8).reshape(-1, n_values)
            # rows k apart, k = 1, 2, ...; pairs already joined need no look, and
            # nothing is kept of a pair but its effect on the roots
            root = np.arange(len(unit))
            alive, k = np.arange(len(unit)), 1
            while True:
                alive = alive[alive + k < len(unit)]
                alive = alive[unit[alive] == unit[alive + k]]
                if len(alive) == 0:
                    break
                apart = alive[root[alive] != root[alive + k]]
                for at in range(0, len(apart), 1 << 13):
                    i = apart[at:at + (1 << 13)]
                    hit = i[(sig[i] == sig[i + k]).sum(axis=1) >= agree]
                    if len(hit):
                        root = _roots(len(unit), root[hit], root[hit + k])[root]
                k += 1
            # equal signatures: the first class of a unit that has it stands for the rest
            seen: dict[tuple, int] = {}
            first = np.array([seen.setdefault((u, x.tobytes()), at) for at, (u, x) in enumerate(zip(unit.tolist(), sig))])
            equal = np.flatnonzero(first != np.arange(len(unit)))
            joined = np.flatnonzero((root != np.arange(len(unit))) & (first == np.arange(len(unit))))
            if len(equal) + len(joined) == 0:
                continue
            a, b = np.concatenate([equal, joined]), np.concatenate([first[equal], root[joined]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[x] for x in a], pa.binary()), pa.array([keys[x] for x in b], pa.binary()),
                 pa.array(np.arange(len(a)) < len(equal))], names=["a", "b", "absorbed"])
    return run


def _candidate_edges(classes: DataFrame, prefix: int, trees: int, depth: int, agree: int) -> DataFrame:
    """Spanning edges of one round of the forest at a prefix length."""
    labels = classes.where("n_shingles > 0").select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "sig").select(
        "key", F.xxhash64("tree", F.expr(f"substring(sig, tree * {depth} + 1, {prefix})")).alias("node"))
    nodes = labels.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    members = labels.join(nodes, "node")
    # a node of many classes is compared as pairs of bounded blocks
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("key"), n_blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), n_blocks - 1))
    members = members.select("node", "key", mine.alias("mine"), other.alias("other")).select(
        F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "key")
    units = members.join(classes.select("key", "sig"), "key").select("unit", "key", "sig")
    units = units.repartition("unit").sortWithinPartitions("unit", "key")
    return units.mapInArrow(_span(trees * depth, agree), "a binary, b binary, absorbed boolean")


def _verify(shingle: int, threshold: float):
    """Exact links inside a unit: partial link counts and spanning edges.

    Input rows: unit, mine, first, second, key, copies, text, sorted by unit. A
    unit holds the blocks ``first`` and ``second`` of a component; pairs inside
    one block are counted in that block's own unit alone.
    """
    def run(batches):
        for t in _whole_units(batches):
            unit = t.column("unit").to_numpy()
            cuts = np.flatnonzero(np.diff(unit)) + 1
            for rows in np.split(np.arange(len(unit)), cuts):
                out = _unit_links(t.slice(int(rows[0]), len(rows)), shingle, threshold)
                if out is not None:
                    yield out
    return run


def _unit_links(t: pa.Table, shingle: int, threshold: float):
    keys = t.column("key").to_pylist()
    n = len(keys)
    if n < 2:
        return None
    mine, copies = t.column("mine").to_numpy(), t.column("copies").to_numpy()
    inside = t.column("first")[0].as_py() == t.column("second")[0].as_py()
    sh, first = T.batch_shingles(*T.batch_words(*T.arrow_bytes(t.column("text"))), shingle)
    counts = np.diff(first)
    owner = np.repeat(np.arange(n), counts)
    order = np.lexsort((owner, sh))
    sh, owner = sh[order], owner[order]
    keep = np.ones(len(sh), dtype=bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    sh, owner = sh[keep], owner[keep]
    size = np.bincount(owner, minlength=n)
    new = np.ones(len(sh), dtype=bool)
    new[1:] = sh[1:] != sh[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), dtype=np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], np.diff(column) > 0]))
        width = max(256, (1 << 22) // n)
        bounds = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi > lo:
                block = np.zeros((n, int(column[hi - 1] - column[lo]) + 1), dtype=np.float32)
                block[owner[lo:hi], column[lo:hi] - column[lo]] = 1
                common += block @ block.T
    joint = size[:, None] + size[None, :] - common
    link = common >= threshold * joint - 1e-6
    np.fill_diagonal(link, False)
    if not inside:
        link &= mine[:, None] != mine[None, :]
    links = (link * copies[None, :]).sum(axis=1)
    i, j = np.nonzero(np.triu(link))
    root = _roots(n, i, j) if len(i) else np.arange(n)
    some = np.flatnonzero((links > 0) | (root != np.arange(n)))
    if len(some) == 0:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[x] for x in some], pa.binary()), pa.array([keys[x] for x in root[some]], pa.binary()),
         pa.array(links[some], pa.int64())], names=["key", "root", "links"])


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of the group joined
    by links), text_id (least doc_id among equal word sequences), n_links
    (documents linked to it, copies included), n_shingles."""
    sketched, info = _linked(docs, **options)
    has = F.col("n_shingles") > 0
    return sketched.withColumn("key", F.when(has, F.col("key"))).join(info, "key", "left").select(
        "doc_id", F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.col("text_id")).otherwise(F.col("doc_id")).alias("text_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_shingles")


def _linked(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES,
            depth: int = DEPTH, target_recall: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_shingles, sig per row; key, text_id, class_id, group, n_links per class)."""
    n_values = trees * depth
    base = docs.select("doc_id", "text")
    sketched = cut(base.mapInArrow(
        _sketch(shingle, n_values),
        f"doc_id {dict(base.dtypes)['doc_id']}, key binary, n_shingles long, sig binary"))
    classes = cut(sketched.where("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("text_id"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"),
        F.min("sig").alias("sig")))
    # candidates: signatures that agree to four standard deviations below the threshold
    agree = int(n_values * (threshold - 4 * (threshold * (1 - threshold) / n_values) ** 0.5))
    edges, alive = None, classes
    schedule = prefix_schedule(threshold, trees, depth, target_recall)
    for prefix in schedule:
        found = cut(_candidate_edges(alive, prefix, trees, depth, agree))
        edges = found if edges is None else edges.unionByName(found)
        if prefix != schedule[-1]:
            gone = found.where("absorbed").select(F.col("a").alias("key")).distinct()
            alive = alive.join(gone, "key", "left_anti")
    parts = cut(components(edges))
    # exact verification inside the candidate components
    member = parts.select(F.col("node").alias("key"), F.col("root").alias("part")).join(
        classes.select("key", "text_id", "copies", "n_shingles"), "key")
    sizes = member.groupBy("part").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    member = member.join(sizes, "part")
    n_blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / F.lit(BLOCK_SHINGLES))).cast("int")
    member = member.select("key", "text_id", "copies", "part", n_blocks.alias("blocks"))
    wanted = member.withColumnRenamed("text_id", "doc_id")
    texts = base.join(wanted, base["doc_id"].eqNullSafe(wanted["doc_id"])).select(
        "key", "copies", "part", "blocks", "text")
    texts = _own_texts(texts, shingle)
    units = texts.select("key", "copies", "part", "blocks", "text",
                         F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("mine")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        F.xxhash64("part", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"),
        "mine", F.least("mine", "other").alias("first"), F.greatest("mine", "other").alias("second"),
        "key", "copies", "text")
    units = units.repartition("unit").sortWithinPartitions("unit")
    links = cut(units.mapInArrow(_verify(shingle, threshold), "key binary, root binary, links long"))
    groups = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    info = classes.select("key", "text_id", "copies").join(
        groups.select(F.col("node").alias("key"), F.col("root").alias("group")), "key", "left").join(
        counts, "key", "left").withColumn("group", F.coalesce("group", "key"))
    low = info.groupBy("group").agg(F.min("text_id").alias("class_id"))
    info = info.join(low, "group").select(
        "key", "group", "text_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sketched, info


def _own_texts(texts: DataFrame, shingle: int) -> DataFrame:
    """Keep the rows whose text is of the wanted class (a doc_id can stand on
    rows of several texts), one row per class."""
    kinds = dict(texts.dtypes)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 4):
                keys = _class_keys(*T.batch_words(*T.arrow_bytes(b.column(4))))
                want = b.column(0).to_pylist()
                same = [k.tobytes() == w for k, w in zip(keys, want)]
                yield b.filter(pa.array(same, pa.bool_()))
    own = texts.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in texts.columns))
    return own.dropDuplicates(["key"])


def _tagged(docs: DataFrame) -> DataFrame:
    """``docs`` with the class key of its text as a last column ``_key`` (null without words)."""
    at = docs.columns.index("text")

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                words, first = T.batch_words(*T.arrow_bytes(b.column(at)))
                keys = [k.tobytes() if n else None for k, n in zip(_class_keys(words, first), np.diff(first))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*b.schema.names, "_key"])
    schema = T_.StructType([*docs.schema.fields, T_.StructField("_key", T_.BinaryType())])
    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row of each near-duplicate group left: a row of the
    group's least doc_id (nulls last, then the least class key; of rows that
    repeat both, one). Documents without words all stay. All columns are kept."""
    _, info = _linked(docs, **options)
    order = F.struct(F.col("text_id").isNull().alias("n"), F.col("text_id"), F.col("key"))
    stay = info.groupBy("group").agg(F.min(order).alias("s")).select(
        F.col("s.key").alias("_key"), F.col("s.text_id").alias("_id"))
    rows = _tagged(docs)
    kept = rows.where("_key is not null").join(stay, "_key").where("doc_id <=> _id").dropDuplicates(["_key"])
    return kept.select(*docs.columns).unionByName(rows.where("_key is null").select(*docs.columns))
