"""Filter interaction audit: what each filter removes, at every place of every order.

Five filters judge a text (a text that fails goes):

* A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals A-Z > 5 * code
  points; D: holds one of ``#$%&*|``; E: identical to the text of any smaller doc_id.

Each document's failures are one mask of five bits, so a part of the corpus is told by at
most 32 cells (mask, documents, good ones, toxic ones), whatever its size. Every cell is
folded over the array of all 120 orders (a constant of the plan, which goes out with the
tasks): ``transform`` walks orders and steps, ``aggregate`` folds the mask of the filters
before a step, which gives 600 weighted structs. The arrays of a part's cells are merged by
elementwise sums (32 arrays at most), and a filter's Shapley total is a fold over the result.

Texts are read once, in Arrow batches and pieces of ``PIECE`` bytes, and never shuffled:
only (doc_id, digest, part, mask) goes on. Whether a smaller doc_id has the text needs the
least doc_id per digest (a partial aggregation, so a text that a third of all rows share is
one row per task) and an equi-join on (digest, doc_id), which a common text doesn't skew.
Texts are taken as identical if their SHA-256 is.

Cases: a null text is empty (and identical to empty ones); a null source is the part ``''``,
with the empty source; a null doc_id is neither smaller nor larger than another, so it never
fails E, and has no label; rows that repeat a doc_id and text are documents each, none of
which is smaller than the other; several labels of one doc_id count as good or toxic if any
of them is; an empty text fails A, not B, C or D; a text of any length is read whole (held at
once: a piece and its distinct words); an empty table has no parts, hence no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut, slices

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65      # per cent of the words
MAX_CAPITALS = 5       # per cent of the code points
MARKS = b"#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
PIECE = 1 << 20
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_NOT_CAPITAL = bytes(c for c in range(256) if not 0x41 <= c <= 0x5A)
_NOT_MARK = bytes(c for c in range(256) if c not in MARKS)
_FOLLOW = bytes(range(0x80, 0xC0))
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def text_mask(data: bytes, piece: int = PIECE) -> int:
    """The failures of A to D (bits 0 to 3) of one text in UTF-8."""
    words, capitals, points, marked = 0, 0, 0, False
    distinct: set[bytes] = set()
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + piece) if len(data) > at + piece else None
        end = gap.end() if gap else len(data)
        part = data[at:end]
        found = part.split()                       # bytes split at \x20 and \x09-\x0D
        words += len(found)
        distinct.update(found)
        capitals += len(part.translate(None, _NOT_CAPITAL))
        points += len(part.translate(None, _FOLLOW))
        marked = marked or bool(part.translate(None, _NOT_MARK))
        at = end
    return ((words < MIN_WORDS) | (100 * len(distinct) < MIN_DISTINCT * words) << 1
            | (100 * capitals > MAX_CAPITALS * points) << 2 | marked << 3)


def failures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, part, mask (bits 0 to 4 for A to E)."""
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    id_type = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for whole in batches:
            for b in slices(whole, 2):
                texts = [t or b"" for t in b.column(2).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                     pa.array([text_mask(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])
    facts = cut(rows.mapInArrow(run, f"doc_id {id_type}, part string, digest binary, mask int"))
    least = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    named = facts.where("doc_id is not null").join(least.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    late = F.when(F.col("first").isNull(), 16).otherwise(0)
    return named.select("doc_id", "part", (F.col("mask") + late).alias("mask")).unionByName(
        facts.where("doc_id is null").select("doc_id", "part", "mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask: n, good, toxic (32 rows a part at most)."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = masks.where("doc_id is not null").join(marks, "doc_id", "left").select("part", "mask", "good", "toxic")
    none = masks.where("doc_id is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return named.unionByName(none).groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))


def _orders() -> Column:
    """The broadcast array: per order, the bits of its filters from left to right."""
    return F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in o]) for o in ORDERS])


def _fold() -> Column:
    """One cell's 600 structs: the cell's weights at every step of every order."""
    return F.expr("""flatten(transform(orders, o -> transform(sequence(0, 4), i -> named_struct(
        'bit', o[i], 'before', aggregate(slice(o, 1, i), 0, (seen, f) -> seen | f)))))""")


def _weights() -> Column:
    return F.expr("""transform(steps, x -> named_struct(
        'bit', x.bit,
        'kept', if(mask & (x.before | x.bit) = 0, n, 0L),
        'removed', if(mask & x.bit != 0 and mask & x.before = 0, n, 0L),
        'redundant', if(mask & x.bit != 0 and mask & x.before != 0, n, 0L),
        'unique_fails', if(mask = x.bit, n, 0L),
        'good_lost', if(mask & x.bit != 0 and mask & x.before = 0, good, 0L),
        'toxic_lost', if(mask & x.bit != 0 and mask & x.before = 0, toxic, 0L)))""")


def interactions(part_cells: DataFrame) -> DataFrame:
    """600 rows per part: part, filter_order, step, the measures and shapley."""
    folded = part_cells.withColumn("orders", _orders()).withColumn("steps", _fold()).select("part", _weights().alias("w"))
    both = ", ".join(f"'{m}', a.{m} + b.{m}" for m in MEASURES)
    merged = folded.groupBy("part").agg(F.collect_list("w").alias("w")).select("part", F.expr(
        f"aggregate(slice(w, 2, size(w)), w[0], (sum, x) -> zip_with(sum, x, (a, b) -> named_struct('bit', a.bit, {both})))").alias("w"))
    bits = ", ".join(f"{1 << k}, aggregate(w, 0L, (sum, x) -> sum + if(x.bit = {1 << k}, x.removed, 0L))" for k in range(5))
    rows = merged.withColumn("shapley", F.expr(f"map({bits})")).select("part", "shapley", F.posexplode("w").alias("at", "x"))
    names = F.array(*[F.lit(o) for o in ORDERS])
    return rows.select("part", F.element_at(names, F.expr("cast(at div 5 as int) + 1")).alias("filter_order"),
                       (F.col("at") % 5 + 1).cast("int").alias("step"), *[F.col(f"x.{m}") for m in MEASURES],
                       F.col("shapley")[F.col("x.bit")].alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole audit of ``docs`` with the ``labels`` (doc_id, quality, toxic)."""
    return interactions(cells(failures(docs), labels))


#: DuckDB twin of the registered query
ORACLE = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, part, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM t),
m AS (SELECT doc_id, part,
    {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
     'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'),
     'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS fails FROM f),
b AS (SELECT doc_id, part, fails.A::INT + 2 * fails.B::INT + 4 * fails.C::INT + 8 * fails.D::INT + 16 * fails.E::INT AS mask FROM m),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM b LEFT JOIN l ON b.doc_id = l.doc_id GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM x p, x q, x r, x s, x t
      WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS f,
        1 << (instr('ABCDE', filter_order[step]) - 1) AS bit,
        coalesce(list_sum(list_transform(range(1, step), lambda j: 1 << (instr('ABCDE', filter_order[j]) - 1))), 0)::BIGINT AS before
      FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT part, filter_order, step, f,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c CROSS JOIN s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r"""
