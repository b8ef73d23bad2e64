"""Centroid clustering: Lloyd's rounds whose assignment searches a vantage-point tree.

Vectors are integers (``floor(SCALE * x)`` of each component), so distances, means and ties
are exact. In each round the driver builds a vantage-point tree over the centroids (K rows,
a parameter) and broadcasts it. An inner node holds one centroid, the vantage point, and the
others split at their median distance from it into a near and a far child, each with the
least and greatest distance of its centroids; a leaf holds at most ``LEAF`` centroids.

Each vector searches best first: its frontier is the nodes it has reached with a lower bound
of the distance to anything inside; it takes the node with the least bound, measures the
exact integer distances there, and goes on while a bound is within (inclusive: a centroid at
the same distance with a smaller number must be found) its best distance so far. Bounds come
from square roots and are lowered by more than their rounding error before they are compared.
The vectors of a batch take their steps together, as array operations.

A round is one pass: every batch adds its vectors up per cluster, tasks emit K rows of 64
sums per batch, and a partial aggregation brings K x 64 sums to the driver. The vectors are
quantised once and cut to the shared checkpoint folder as packed integers, so rounds read
neither the table nor arrays of floats again. No vector is shuffled at all.

Cases: a vector that is null, has other than ``dimensions`` components, or one that is null
or not finite is left out, as the contract says; components are read within +-2**27 after
scaling (beyond it a squared distance would not fit a long); sums of distances beyond a long
stay at its maximum; vectors at the same distance of several centroids go to the smaller
number, equal centroids included; repeated rows and equal vec_ids are vectors each; a null
vec_id is seeded last; of rows with the same seed hash the least vector is first; with fewer
vectors than ``k`` there are as many centroids as vectors; an empty cluster keeps its
centroid and has no rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut

K = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
LEAF = 2
LIMIT = 1 << 27
CELLS = 1 << 20        # vectors x max(nodes, dimensions) held at once in a task
MOST = (1 << 63) - 1


def distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 vectors to one centroid."""
    gap = vectors - centroid[None, :]
    return np.einsum("ij,ij->i", gap, gap)


class VantageTree:
    """Nodes as parallel lists: centroid numbers held, and up to two (child, least, greatest)."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids.astype(np.int64)
        self.held: list[list[int]] = []
        self.children: list[list[tuple[int, float, float]]] = []
        if len(centroids):
            self._build(list(range(len(centroids))), leaf)

    def _build(self, members: list[int], leaf: int) -> int:
        node = len(self.held)
        self.held.append(members if len(members) <= leaf else members[:1])
        self.children.append([])
        if len(members) > leaf:
            rest = np.array(members[1:])
            far = np.sqrt(distances(self.centroids[rest], self.centroids[members[0]]).astype(np.float64))
            order = np.argsort(far, kind="stable")
            half = (len(rest) + 1) // 2
            for side in (order[:half], order[half:]):
                if len(side):
                    child = self._build([int(c) for c in rest[side]], leaf)
                    self.children[node].append((child, float(far[side].min()), float(far[side].max())))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, its squared distance, distances measured)."""
        n, step = len(vectors), max(1, CELLS // max(len(self.held), vectors.shape[1] if vectors.ndim > 1 else 1, 1))
        number, best, measured = np.zeros(n, dtype=np.int64), np.full(n, MOST, dtype=np.int64), 0
        for at in range(0, n, step):
            measured += self._search(vectors[at:at + step].astype(np.int64), number[at:at + step], best[at:at + step])
        return number, best, measured

    def _search(self, vectors: np.ndarray, number: np.ndarray, best: np.ndarray) -> int:
        bound = np.full((len(vectors), len(self.held)), np.inf)
        bound[:, 0] = 0
        active, measured = np.arange(len(vectors)), 0
        while len(active):
            node = bound[active].argmin(axis=1)
            least = bound[active, node]
            open_ = np.isfinite(least) & (least <= np.sqrt(best[active].astype(np.float64)))   # inclusive
            active, node = active[open_], node[open_]
            for k in np.unique(node):
                mine = active[node == k]
                bound[mine, k] = np.inf
                here = None
                for c in self.held[k]:
                    d = distances(vectors[mine], self.centroids[c])
                    here = d if here is None else here
                    measured += len(mine)
                    better = (d < best[mine]) | ((d == best[mine]) & (c < number[mine]))
                    best[mine[better]], number[mine[better]] = d[better], c
                if self.children[k]:
                    root = np.sqrt(here.astype(np.float64))    # to the vantage point
                    for child, low, high in self.children[k]:
                        gap = np.maximum(np.maximum(root - high, low - root), 0)
                        bound[mine, child] = np.maximum(gap - 1e-9 * (root + high) - 1e-6, 0)
        return measured


def quantise(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the valid vectors as packed little-endian 32-bit integers."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") == dimensions) & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    id_type = dict(rows.dtypes)["vec_id"]

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dimensions)
                v = np.clip(np.floor(np.clip(x, -2 * LIMIT, 2 * LIMIT) * scale), -LIMIT, LIMIT).astype("<i4")
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in v], pa.binary())], names=["vec_id", "v"])
    return rows.mapInArrow(run, f"vec_id {id_type}, v binary")


def _unpacked(column, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(len(column), dimensions).astype(np.int64)


def _seeds(packed: DataFrame, k: int, dimensions: int) -> np.ndarray:
    """The k vectors with the least hash of their id; only these reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    rows = packed.select(key.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([np.frombuffer(bytes(r["v"]), dtype="<i4") for r in rows], dtype=np.int64).reshape(len(rows), dimensions)


def _round(packed: DataFrame, tree: VantageTree, dimensions: int) -> np.ndarray:
    """The centroids after one round."""
    shared = packed.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        k = len(shared.value.centroids)
        total, count = np.zeros((k, dimensions), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            v = _unpacked(b.column(1), dimensions)
            number, _, _ = shared.value.nearest(v)
            count += np.bincount(number, minlength=k)
            for c in np.unique(number):
                total[c] += v[number == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dimensions).astype(np.int32)), pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(used))),
             pa.array(total[used].ravel()), pa.array(np.repeat(count[used], dimensions))], names=["cluster", "place", "total", "n"])
    sums = packed.mapInArrow(run, "cluster int, place int, total long, n long")
    sums = sums.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = tree.centroids.copy()
    for r in sums.collect():                        # K x dimensions rows
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def _assigned(packed: DataFrame, tree: VantageTree, dimensions: int) -> DataFrame:
    shared = packed.sparkSession.sparkContext.broadcast(tree)
    id_type = dict(packed.dtypes)["vec_id"]

    def run(batches):
        for b in batches:
            number, best, _ = shared.value.nearest(_unpacked(b.column(1), dimensions))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number.astype(np.int32)), pa.array(best)],
                                             names=["vec_id", "cluster", "distance"])
    return packed.mapInArrow(run, f"vec_id {id_type}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Per valid vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    packed = cut(quantise(vectors, dimensions, scale))
    centroids = _seeds(packed, k, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        after = _round(packed, VantageTree(centroids), dimensions)
        if np.array_equal(after, centroids):        # a fixpoint: the rounds left would repeat it
            break
        centroids = after
    out = cut(_assigned(packed, VantageTree(centroids), dimensions))
    sums = {r["cluster"]: int(r["d"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = min(sum(sums.values()), MOST)
    stats = [(c, min(d, MOST), whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in sums.items()]
    table = spark.createDataFrame(stats, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(table), "cluster").select(    # K rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = K, rounds: int = ROUNDS) -> str:
    """DuckDB twin of the registered query: every round as a step of plain SQL."""
    steps = [f"""
q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v AS m
      FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM q ORDER BY h LIMIT {k}))"""]
    gap = "list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT vec_id, v, c, d FROM (SELECT vec_id, v, c, {gap} AS d FROM q CROSS JOIN c{i})
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (
      SELECT c, list(((s - ((s % w) + w) % w) // w)::BIGINT ORDER BY i) AS m FROM (
        SELECT c, i, sum(v[i]) AS s, count(*) AS w FROM (SELECT c, v, unnest(range(1, {DIMENSIONS + 1})) AS i FROM a{i}) GROUP BY c, i)
      GROUP BY c) n ON n.c = o.c)""")
    return "WITH " + ",".join(steps) + f"""
SELECT a.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON k.c = a.c"""


ORACLE = oracle()
