"""URL filter: ordered host/path rules, then a Bloom filter cascade [native].

A rule (host, path) fits its host and all subdomains if the url's path starts with
the rule's path; the longest rule wins. A url without a rule is judged by the list
of blocked keys, held as a cascade: level 1 is a Bloom filter of the listed keys,
level 2 one of the unlisted keys of the universe that pass level 1, level 3 one of
the listed keys that pass level 2, and so on until no key passes wrongly. For every
key of the universe (all keys of the corpus) the first level that rejects it tells
exactly whether it is listed, so pages need no join and no list of keys.

Keys are dealt to shards of about ``SHARD_KEYS`` listed keys by hash; each shard has
its own cascade, whose arrays are bounded. Levels are built by aggregation (bits
or-ed per word, words collected per shard). If all shards together take at most
``MAX_BYTES``, they reach the scan as one scalar subquery; beyond that, pages are
joined with their shard's row.

Cases: of fitting rules of equal length the last one listed counts; a very long url is
judged whole; a url that is null or has no ``://`` has an empty host and path and is judged
like any other; letters outside A-Z keep their case; repeated urls and page_ids keep
a row each; a key outside the universe can't occur (the universe is taken from the
same pages); an empty list allows every url without a rule; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut

HASHES = 4
BITS_PER_KEY = 6
SHARD_KEYS = 50_000
MAX_BYTES = 16 << 20
#: fixed values of the contract: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: words in a host that put it on the block list of the registered query
LISTED_TERMS = ("spam", "pills", "bets", "adult", "casino")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r_host, r_path, r_verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        name = F.when(fits, F.lit(r_host + r_path)).otherwise(name)
        verdict = F.when(fits, F.lit(r_verdict)).otherwise(verdict)
    return name, verdict


def _positions(level) -> str:
    return f"transform(sequence(0, {HASHES - 1}), j -> pmod(xxhash64(key, {level}, j), m))"


def _passes(level, words: str, m: str) -> str:
    return f"""forall(sequence(0, {HASHES - 1}), j ->
        (shiftright({words}[cast(pmod(xxhash64(key, {level}, j), {m}) div 64 as int)], cast(pmod(xxhash64(key, {level}, j), {m}) % 64 as int)) & 1) = 1)"""


def build_cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame | None, int]:
    """(one row (shard, levels) per shard, number of shards) for ``universe``
    (key, listed: every key once). ``levels`` is array<struct<level,m,words>>."""
    listed = universe.where("listed").count()
    if listed == 0:
        return None, 0
    shards = -(-listed // shard_keys)
    keys = cut(universe.select("key", "listed", F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards)).cast("int").alias("shard")))
    inc, exc = keys.where("listed").select("shard", "key"), keys.where("not listed").select("shard", "key")
    levels, level = None, 0
    while True:
        level += 1
        size = inc.groupBy("shard").agg((F.ceil(F.count("*") * BITS_PER_KEY / 64) * 64).cast("long").alias("m"))
        bits = inc.join(size, "shard").select("shard", F.explode(F.expr(_positions(level))).alias("p")).select(
            "shard", F.expr("p div 64").cast("int").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bits"))
        blank = size.select("shard", F.explode(F.expr("sequence(0, cast(m div 64 as int) - 1)")).alias("word"), F.lit(0).cast("long").alias("bits"))
        words = bits.unionByName(blank).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
        one = words.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w")).select(
            "shard", F.lit(level).alias("level"), (F.size("w") * 64).cast("long").alias("m"), F.expr("w.bits").alias("words"))
        one = cut(one)
        levels = one if levels is None else levels.unionByName(one)
        wrong = cut(exc.join(one, "shard").where(F.expr(_passes(level, "words", "m"))).select("shard", "key"))
        if wrong.isEmpty():
            break
        inc, exc = wrong, inc
    return cut(levels.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("level", "m", "words"))).alias("levels"))), shards


def is_listed(rows: DataFrame, cascade: DataFrame | None, shards: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` (with a column ``key``) and a boolean column ``listed``."""
    if cascade is None:
        return rows.withColumn("listed", F.lit(False))
    size = cascade.agg(F.sum(F.expr("aggregate(levels, 0L, (a, x) -> a + 8 * size(x.words))"))).first()[0]
    shard = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards)).cast("int")
    if size <= max_bytes:
        whole = cascade.agg(F.map_from_entries(F.collect_list(F.struct("shard", "levels"))).alias("all"))
        rows = rows.withColumn("_levels", F.element_at(whole.scalar(), shard))
    else:
        rows = rows.withColumn("_shard", shard).join(cascade.select(F.col("shard").alias("_shard"), F.col("levels").alias("_levels")),
                                                     "_shard", "left").drop("_shard")
    # the first level that rejects the key; a level may be missing where nothing passed wrongly
    first = F.expr(f"aggregate(coalesce(_levels, array()), struct(0 as passed, true as going), (a, x) -> if(a.going and {_passes('x.level', 'x.words', 'x.m')},"
                   " struct(a.passed + 1 as passed, true as going), struct(a.passed as passed, false as going)), a -> a.passed)")
    return rows.withColumn("listed", first % 2 == 1).drop("_levels")


def judge(pages: DataFrame, rules=RULES, terms=LISTED_TERMS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. The list of the query: the
    hosts that hold one of ``terms``; the universe: all hosts of the pages."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = F.lit(False)
    for term in terms:
        listed = listed | F.col("key").contains(term)
    universe = rows.select(F.col("host").alias("key")).distinct().withColumn("listed", listed)
    cascade, shards = build_cascade(universe)
    out = is_listed(rows.withColumn("key", F.col("host")), cascade, shards)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return out.select("page_id", "host", "path", name.alias("rule"),
                      F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
