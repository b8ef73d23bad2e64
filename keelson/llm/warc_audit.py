"""Merkle fixity audit of WARC records held in two replicas.

A record is its WARC header and payload; its slot is its id, and slots in order are
its place in the archive: files of ``2**FILE_BITS`` slots, byte offsets running
within a file. Each replica is hashed alone into a tree over the slots: a leaf is
the digest of a slot's records, a node the digest of the digests and byte lengths of
its ``2**FAN_BITS`` children in order, so a node stands for an ordered range of
offsets. Only then do the replicas meet: their roots are compared, and of every level
below only the children of nodes that differ are read and joined, down to the corrupt
records. A lost record changes its own path and no other.

A tree is a table per level in the shared checkpoint folder. The levels that grow
with the archive lie in at most ``2 * PARTS`` folders of slot ranges, and the descent
reads only the folders below differing nodes: replicas that agree cost their roots, a
few faults cost a few folders of leaves. Records that share a slot are summed (their
digests as numbers), which needs no order and is pre-aggregated, so a slot that
holds a third of all rows is no hot group.

Cases: a null payload or url is empty; a payload of any length is hashed whole within
its row; a record with a null id has the hash of its url as slot (slots then span all 64
bits, and those of plain ids share one folder); repeated rows are further records of
their slot, whose order does not matter; columns besides page_id, url and html are
ignored, whatever their names; two empty replicas agree (no rows), against an
empty one every slot is missing or extra.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut, scratch

FAN_BITS = 4
FILE_BITS = 10
#: folders of a level (twice as many if slots of both signs are there); a power of the fan
PARTS = 256
_PARTS = 4


def _record(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _slot() -> Column:
    return F.coalesce(F.col("page_id").cast("long"), F.xxhash64("url"))


def records(pages: DataFrame) -> DataFrame:
    """slot, digest (SHA-256 hex) and n_bytes of every page's WARC record."""
    html = _record("html")
    text = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), _record("url"), F.lit("\r\nWARC-Record-ID: "),
                    _record("page_id"), F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"),
                    F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    return pages.select(_slot().alias("slot"), text.alias("record")).select(
        "slot", F.sha2("record", 256).alias("digest"), F.octet_length("record").cast("long").alias("n_bytes"))


def _leaves(pages: DataFrame) -> DataFrame:
    """slot, n (records), n_bytes and hash of a replica's slots."""
    sums = []
    for p in range(_PARTS):                        # 60 bits each
        part = F.conv(F.substring("digest", 1 + 15 * p, 15), 16, 10).cast("decimal(38,0)")
        sums.append(F.sum(part).alias(f"s{p}"))
    leaf = records(pages).groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("n_bytes"), *sums)
    text = F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"s{p}").cast("string") for p in range(_PARTS)])
    return leaf.select("slot", "n", "n_bytes", F.sha2(text, 256).alias("hash"))


def _parents(nodes: DataFrame) -> DataFrame:
    kids = F.array_sort(F.collect_list(F.struct("slot", "hash", "n_bytes")))   # at most 2**FAN_BITS
    text = F.concat_ws(",", F.transform(kids, lambda x: F.concat_ws(":", x["slot"].cast("string"), x["hash"], x["n_bytes"].cast("string"))))
    return nodes.groupBy(F.shiftright("slot", FAN_BITS).alias("slot")).agg(
        F.sum("n").alias("n"), F.sum("n_bytes").alias("n_bytes"), F.sha2(text, 256).alias("hash"))


class Tree:
    """One replica's levels, written: ``levels[0]`` are the leaves, ``levels[top]`` the root
    (two halves if slots have both signs). Levels below ``split`` lie in a folder per node of
    level ``split``, of which there are at most ``2 * PARTS``."""

    def __init__(self, pages: DataFrame, top: int):
        self.top, self.split = top, max(0, top - (PARTS.bit_length() - 1) // FAN_BITS)
        spark = pages.sparkSession
        home = f"{scratch(spark)}/merkle-{uuid.uuid4().hex}"
        self.levels = []
        for level in range(top + 1):
            nodes = _parents(self.levels[-1]) if level else _leaves(pages)
            if level < self.split:
                nodes = nodes.withColumn("part", F.shiftright("slot", FAN_BITS * (self.split - level)))
                nodes.repartitionByRange("slot").write.partitionBy("part").parquet(f"{home}/{level}")
            else:
                nodes.write.parquet(f"{home}/{level}")
            self.levels.append(spark.read.schema(nodes.schema).parquet(f"{home}/{level}"))

    def folders(self, level: int, at: DataFrame, bits: int) -> DataFrame:
        """The level's nodes in the folders that the slots of ``at`` (ranges of ``2**bits``
        leaves) lie in; only folder numbers, at most ``2 * PARTS``, reach the driver."""
        up = FAN_BITS * self.split - bits
        if level >= self.split or up < 0:
            return self.levels[level]
        parts = [r[0] for r in at.select(F.shiftright("slot", up).alias("part")).distinct().collect()]
        return self.levels[level].where(F.col("part").isin(parts))

    def children(self, level: int, parents: DataFrame) -> DataFrame:
        """The nodes of ``level`` below ``parents`` (slots of the level above)."""
        nodes = self.folders(level, parents, FAN_BITS * (level + 1))
        return nodes.join(parents.select(F.col("slot").alias("parent")), F.shiftright(nodes["slot"], FAN_BITS) == F.col("parent"), "left_semi")


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of two trees' one level that differ or stand in one tree alone."""
    def side(nodes, s):
        return nodes.select("slot", F.col("hash").alias(f"{s}_hash"), F.col("n").alias(f"{s}_n"), F.col("n_bytes").alias(f"{s}_bytes"))
    both = side(a, "a").join(side(b, "b"), "slot", "full")
    return both.where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))


def _top(*replicas: DataFrame) -> int:
    """Steps from the leaves to a level of slots 0 and -1 only, for all replicas."""
    ends = [0]
    for pages in replicas:
        ends += [v for v in pages.select(_slot().alias("slot")).agg(F.min("slot"), F.max("slot")).first() if v is not None]
    top = 0
    while any(v >> (FAN_BITS * top) not in (0, -1) for v in ends):
        top += 1
    return top


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """The corrupt slots of replica ``b`` against ``a`` (tables of page_id, url,
    html): slot, fault (altered, missing, extra), file, the slot's offset range in
    the file of ``a``, records and bytes in both, leaf digests and the number of
    tree levels descended."""
    top = _top(a, b)
    here, there = Tree(a, top), Tree(b, top)
    bad = cut(_differing(here.levels[top], there.levels[top]))
    for level in reversed(range(top)):
        bad = cut(_differing(here.children(level, bad), there.children(level, bad)))
    # offsets: running bytes over the slots before it in its file (bounded by the file's slots)
    file = F.shiftright("slot", FILE_BITS).alias("file")
    files = cut(bad.select(file).distinct())
    inside = here.folders(0, files.select(F.col("file").alias("slot")), FILE_BITS).select("slot", "n_bytes", file)
    known = inside.join(files, "file", "left_semi").select("file", "slot", "n_bytes").unionByName(
        bad.where("a_hash is null").select(file, "slot", F.lit(0).cast("long").alias("n_bytes")))
    before = Window.partitionBy("file").orderBy("slot").rowsBetween(-(1 << FILE_BITS), -1)
    place = known.select("file", "slot", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).cast("long").alias("offset_start"))
    fault = F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "extra").otherwise("altered")
    none = F.lit(0).cast("long")
    return bad.join(place, "slot").select(
        "slot", fault.alias("fault"), "file", "offset_start", (F.col("offset_start") + F.coalesce("a_bytes", none)).alias("offset_end"),
        F.coalesce("a_n", none).alias("records_a"), F.coalesce("b_n", none).alias("records_b"),
        F.coalesce("a_bytes", none).alias("bytes_a"), F.coalesce("b_bytes", none).alias("bytes_b"), "a_hash", "b_hash", F.lit(top + 1).alias("levels"))


def faulty_replica(pages: DataFrame) -> DataFrame:
    """A second copy for the registered query, derived from the pages: records of
    hosts with ``pills`` are lost, of ``adult`` cut short, of ``bets`` altered in one
    character, and those of ``spam`` stand twice."""
    lost = F.coalesce(F.col("url").contains("pills"), F.lit(False))
    html = F.when(F.col("url").contains("adult"), F.expr("substring(html, 1, cast(length(html) / 2 as int))")).when(
        F.col("url").contains("bets"), F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    copies = F.when(F.col("url").contains("spam"), F.expr("array(0, 1)")).otherwise(F.expr("array(0)"))
    return pages.where(~lost).select("page_id", "url", html.alias("html"), F.explode(copies).alias("copy")).drop("copy")


_TEXT = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
 || 'WARC-Record-ID: ' || page_id || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
 || html || chr(13) || chr(10) || chr(13) || chr(10)"""
_SUM = " || ':' || ".join(f"sum(('0x' || substr(sha256(record), {1 + 15 * p}, 15))::BIGINT)" for p in range(_PARTS))
#: DuckDB twin of the registered query: every slot of both replicas is compared
ORACLE = f"""
WITH b AS (SELECT page_id, url, CASE WHEN url LIKE '%adult%' THEN substr(html, 1, length(html) // 2)
                                     WHEN url LIKE '%bets%' THEN '#' || substr(html, 2) ELSE html END AS html
           FROM pages, (VALUES (0), (1)) v(copy) WHERE url NOT LIKE '%pills%' AND (copy = 0 OR url LIKE '%spam%')),
ra AS (SELECT page_id AS slot, {_TEXT} AS record FROM pages), rb AS (SELECT page_id AS slot, {_TEXT} AS record FROM b),
la AS (SELECT slot, count(*) AS n, sum(strlen(record)) AS bytes, sha256(count(*) || ':' || {_SUM}) AS hash FROM ra GROUP BY slot),
lb AS (SELECT slot, count(*) AS n, sum(strlen(record)) AS bytes, sha256(count(*) || ':' || {_SUM}) AS hash FROM rb GROUP BY slot),
m AS (SELECT coalesce(la.slot, lb.slot) AS slot, la.n AS an, lb.n AS bn, la.bytes AS ab, lb.bytes AS bb, la.hash AS ah, lb.hash AS bh
      FROM la FULL JOIN lb ON la.slot = lb.slot),
o AS (SELECT *, slot >> {FILE_BITS} AS file,
             coalesce(sum(ab) OVER (PARTITION BY slot >> {FILE_BITS} ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM m),
d AS (SELECT ceil(ln(max(slot) + 1) / ln({1 << FAN_BITS}))::INTEGER + 1 AS levels FROM m)
SELECT slot, CASE WHEN bn IS NULL THEN 'missing' WHEN an IS NULL THEN 'extra' ELSE 'altered' END AS fault, file,
       o::BIGINT AS offset_start, (o + coalesce(ab, 0))::BIGINT AS offset_end, coalesce(an, 0) AS records_a, coalesce(bn, 0) AS records_b,
       coalesce(ab, 0)::BIGINT AS bytes_a, coalesce(bb, 0)::BIGINT AS bytes_b, ah AS a_hash, bh AS b_hash, levels
FROM o, d WHERE ah IS DISTINCT FROM bh"""
