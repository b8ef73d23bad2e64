"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its target share of the output over its
number of documents. A document's count is a Poisson draw with that mean: a uniform
number from a hash of (seed, doc_id) is looked up in the source's cumulative Poisson
distribution (inversion), so the draw depends on nothing else and any executor
repeats it alike. A mean above ``MAX_MEAN`` is split into equal parts below it, each with a
draw of its own (a sum of Poisson draws is a Poisson draw), so a source of few documents
and a large target has a distribution of at most 200 entries, too. Documents are exploded by their count and dealt to partitions by
the hash of (seed, doc_id, copy), sorted by it there: a global shuffle without a
range sample.

Rates are one row per source from a partial aggregation. Up to ``MAX_BROADCAST``
sources they are broadcast (the bound is counted first; a source takes 1.6 KB at most), else joined, where the
adaptive skew join splits a hot source.

Cases: a null source is a source; a null doc_id draws like the text 'null'; rows that
share a doc_id draw alike; equal shuffle keys (of such rows) stay in any order; a source without a weight or of weight 0 is left out; a
null or empty text is a document like any other; an empty table gives no rows; other
columns are kept (``copy``, ``n_copies`` and ``shuffle_key`` replace columns of that name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut

SEED = 7
MAX_BROADCAST = 10_000
MAX_MEAN = 64          # of one draw
EXPLODE = 10_000       # copies listed at a time


def rates(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None, source: str = "source") -> DataFrame:
    """(source, rate, draws, cdf): mean repetition per source, the number of draws
    it is split into and the cumulative distribution of one. Without ``weights`` (source, weight) all sources weigh the same;
    ``total`` defaults to the number of documents."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(w, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").where("weight > 0")
    sizes = cut(sizes)
    sums = sizes.agg(F.sum("n"), F.sum("weight")).first()
    target = total if total is not None else sums[0] or 0
    rate = F.col("weight") / F.lit(float(sums[1] or 1)) * F.lit(float(target)) / F.col("n")
    out = sizes.select("source", rate.alias("rate")).withColumn("draws", F.greatest(F.ceil(F.col("rate") / MAX_MEAN), F.lit(1)).cast("int"))
    out = out.withColumn("mean", F.col("rate") / F.col("draws"))
    # P(count <= k) up to far in the tail; terms by their logarithm, so that large means don't underflow
    return out.withColumn("cdf", F.expr("""aggregate(
        sequence(0, cast(ceil(mean + 12 * sqrt(mean) + 30) as int)),
        named_struct('log', -mean, 'sum', cast(0 as double), 'out', cast(array() as array<double>)),
        (a, k) -> named_struct(
          'log', a.log + ln(mean) - ln(cast(k + 1 as double)),
          'sum', a.sum + exp(a.log),
          'out', concat(a.out, array(a.sum + exp(a.log)))),
        a -> a.out)""")).select("source", "rate", "draws", "cdf")


def uniform(seed: int, *columns) -> F.Column:
    """A number in (0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def replicate(docs: DataFrame, weights: DataFrame | None = None, *, total: int | None = None, seed: int = SEED,
              source: str = "source", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` repeated to the target weights and shuffled: all columns, and copy
    (0-based), n_copies and shuffle_key."""
    table = cut(rates(docs, weights, total, source).select(
        F.col("source").alias("_source"), F.col("draws").alias("_draws"), F.col("cdf").alias("_cdf")))
    small = F.broadcast(table) if table.count() <= max_broadcast else table
    kept = [f"`{c}`" for c in docs.columns if c not in ("copy", "n_copies", "shuffle_key")]
    rows = docs.join(small, F.col(source).eqNullSafe(F.col("_source"))).withColumn("_u", uniform(seed, "doc_id"))
    more = f"""(cast(conv(substring(md5(concat_ws('|', '{seed}', coalesce(cast(doc_id as string), 'null'), 'draw', cast(j as string))), 1, 13), 16, 10)
        as double) + 0.5D) / {float(1 << 52)}D"""
    first = "size(filter(_cdf, c -> c < _u))"
    rows = rows.withColumn("n_copies", F.expr(f"""if(_draws = 1, {first}, {first} + aggregate(sequence(1, _draws - 1), 0,
        (n, j) -> n + transform(array({more}), u -> size(filter(_cdf, c -> c < u)))[0]))"""))
    # copies in blocks, so that no list grows with a count
    rows = rows.where("n_copies > 0").select(*kept, "n_copies", F.explode(F.expr(f"sequence(0, cast((n_copies - 1) DIV {EXPLODE} as int))")).alias("_b"))
    rows = rows.select(*kept, "n_copies", F.explode(F.expr(f"sequence({EXPLODE} * _b, least({EXPLODE} * (_b + 1), n_copies) - 1)")).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string")))
    rows = rows.withColumn("shuffle_key", key)
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


#: DuckDB twin of the registered query
ORACLE = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, (1.0 / (SELECT count(*) FROM n)) * (SELECT sum(n) FROM n)::DOUBLE / n AS rate FROM n),
s AS (SELECT source, greatest(ceil(rate / {MAX_MEAN}), 1)::BIGINT AS draws, rate / greatest(ceil(rate / {MAX_MEAN}), 1) AS mean FROM r),
k AS (SELECT source, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 30)::BIGINT + 1)) AS k FROM s),
c AS (SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
j AS (SELECT d.*, unnest(range(0, s.draws)) AS j FROM documents d JOIN s ON d.source = s.source),
d AS (SELECT *, (('0x' || substr(md5('{SEED}|' || doc_id || CASE WHEN j > 0 THEN '|draw|' || j ELSE '' END), 1, 13))::BIGINT::DOUBLE + 0.5)
          / 4503599627370496.0 AS u FROM j),
t AS (SELECT d.doc_id, d.source, d.lang, d.text, count(*) AS n_copies FROM d JOIN c ON d.source = c.source AND c.cdf < d.u
      GROUP BY ALL),
x AS (SELECT *, unnest(range(0, n_copies)) AS copy FROM t)
SELECT doc_id, source, lang, text, n_copies::INTEGER AS n_copies, copy::INTEGER AS copy,
       md5('{SEED}|' || doc_id || '|' || copy) AS shuffle_key FROM x"""
