"""Personal data by bootstrapped contextual extraction [native].

Base spans (email, ip, card, phone) are the seed entities. Every mention, a seed or
an identifier-like token (four digits or more) outside the seeds, has lexical
patterns around it: its two words before, its two words after, and one of each
(lower-cased, digits as 9). Patterns and instances (the mentions' texts) form a
bipartite graph over all documents. In each of ``ROUNDS`` rounds a pattern's
confidence is the sum of its instances' scores over their number plus ``PRIOR``
(seeds score 1), and an unseen instance's score is one minus the product of its
patterns' doubts. The instances of every pattern that ends with at least
``MIN_CONFIDENCE`` and ``MIN_SEEDS`` distinct seeds are discovered: they are seeds of
the next rounds, which go on until nothing more is discovered. A mention is found
if one of its patterns is such a pattern, or if its text is a base seed elsewhere
or a valid card number (two that stand side by side fail as one base
match); its span has the kind ``context``.

Both steps of a round are partial aggregations and many-to-one joins of the
distinct graph edges; texts are read once and never shuffled for it. A pattern that
a third of all mentions share is pre-aggregated, and its edges are split by the
adaptive skew join.

Cases: a null text is empty; a null doc_id joins itself; rows equal in doc_id and
text are judged alike, each keeps its row; equal scores need no order; a text of very many
matches takes time about in proportion (``spans``); other columns are ignored (``redact`` keeps
all); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut, text_or_empty
from keelson.llm.spans import chunks, let, matches, outside, part, redacted, shown, with_pieces

KINDS = ["email", "ip", "card", "phone", "context"]
ROUNDS = 3
PRIOR = 1.0
MIN_CONFIDENCE = 0.8
MIN_SEEDS = 5
REACH = 64             # code points of context that patterns are taken from
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"(?<!\S)[^\s0-9]*+(?:[0-9][^\s0-9]*+){4,}+",
}
_EMPTY = "cast(array() as array<struct<seed:boolean,s:int,e:int,t:string>>)"


def _mentions(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, rid, base (array<struct<k,s,e>>), mentions
    (array<struct<seed,s,e,t,l1,l2,r1,r2>>)."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = with_pieces(rows, PATTERNS).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"), *[matches(k).alias(k) for k in PATTERNS])
    octet = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"
    rows = rows.select("doc_id", "text", "rid", "token",
                       F.col("email"),
                       F.expr(f"filter(ip, x -> x.t rlike '^{octet}(?:\\\\.{octet}){{3}}$')").alias("ip"),
                       F.expr("""filter(card, x -> x.e - x.s >= 13 and length(translate(x.t, ' -', '')) between 13 and 19
                                 and luhn_check(translate(x.t, ' -', '')))""").alias("card"),
                       F.expr("filter(phone, x -> length(regexp_replace(x.t, '[^0-9]', '')) between 9 and 15)").alias("phone"))
    rows = rows.withColumn("base", F.expr("concat(" + ", ".join(
        f"transform({kind}, x -> named_struct('k', {k}, 's', x.s, 'e', x.e))" for k, kind in enumerate(KINDS[:4])) + ")"))
    rows = rows.withColumn("token", F.expr(outside("token", "base")))
    rows = rows.withColumn("found", F.expr(
        "concat(" + ", ".join(f"transform({kind}, x -> named_struct('seed', true, 's', x.s, 'e', x.e, 't', x.t))" for kind in KINDS[:4])
        + """, transform(token, x -> named_struct('seed', false, 's', x.s, 'e', x.e, 't', x.t)))"""))
    # words around a mention, from a bounded reach of text
    around = let("cs", chunks("text"), f"""transform(found, x -> named_struct(
        'seed', x.seed, 's', x.s, 'e', x.e, 't', lower(x.t),
        'l', split(trim(lower(regexp_replace({part("cs", f"greatest(x.s - {REACH}, 0)", "x.s")}, '[0-9]', '9'))), '\\\\s+'),
        'r', split(trim(lower(regexp_replace({part("cs", "x.e", f"x.e + {REACH}")}, '[0-9]', '9'))), '\\\\s+')))""")
    rows = rows.withColumn("found", F.expr(f"if(size(found) = 0, array(), {around})"))
    return rows.select("doc_id", "rid", "base", F.expr("""transform(found, x -> named_struct(
        'seed', x.seed, 's', x.s, 'e', x.e, 't', x.t, 'patterns', array(
          concat('< ', array_join(slice(x.l, greatest(size(x.l) - 1, 1), 2), ' ')),
          concat('> ', array_join(slice(x.r, 1, 2), ' ')),
          concat('<> ', x.l[size(x.l) - 1], ' ', x.r[0]))))""").alias("mentions"))


def _confident(mentions: DataFrame, rounds: int, min_confidence: float, min_seeds: int) -> DataFrame:
    """The patterns that reach enough confidence and seeds, discovered ones included."""
    edges = mentions.groupBy("pattern", "t").agg(F.max("seed").alias("seed"))
    # a pattern without unseen instances can discover nothing and no score depends on it
    useful = edges.groupBy("pattern").agg(F.min("seed").alias("all_seeds")).where("not all_seeds")
    edges = cut(edges.join(useful.select("pattern"), "pattern").select("pattern", "t", "seed"))
    while True:
        scored = edges.withColumn("score", F.col("seed").cast("double"))
        patterns = None
        for k in range(rounds):
            patterns = scored.groupBy("pattern").agg((F.sum("score") / (F.count("*") + F.lit(PRIOR))).alias("confidence"),
                                                     F.sum(F.col("seed").cast("int")).alias("seeds"))
            if k < rounds - 1:
                unseen = scored.where("not seed").join(patterns.select("pattern", "confidence"), "pattern").groupBy("t").agg(
                    (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"))
                scored = cut(scored.drop("score").join(unseen, "t", "left").select(
                    "pattern", "t", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score")))
        good = cut(patterns.where((F.col("confidence") >= min_confidence) & (F.col("seeds") >= min_seeds)).select("pattern"))
        # what the good patterns hold are seeds from now on: seeds only grow, so a good pattern stays good and this ends
        more = cut(edges.where("not seed").join(good, "pattern", "left_semi").select("t").distinct())
        if more.isEmpty():
            break
        edges = cut(edges.join(more.withColumn("more", F.lit(True)), "t", "left").select(
            "pattern", "t", (F.col("seed") | F.coalesce("more", F.lit(False))).alias("seed")))
    return good


def _found(docs: DataFrame, rounds: int, min_confidence: float, min_seeds: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rid, base per row; doc_id, rid, extra per text with discovered spans)."""
    rows = cut(_mentions(docs))
    each = rows.where("size(mentions) > 0").dropDuplicates(["doc_id", "rid"]).select("doc_id", "rid", F.inline("mentions"))
    each = each.select("doc_id", "rid", "seed", "s", "e", "t", F.explode("patterns").alias("pattern"))
    good = _confident(each.select("pattern", "t", "seed"), rounds, min_confidence, min_seeds)
    unseen = each.where("not seed")
    known = each.where("seed").select("t").distinct()
    valid = unseen.where(r"t rlike '^[0-9]{13,19}$' and luhn_check(if(t rlike '^[0-9]{13,19}$', t, '1'))")
    extra = unseen.join(good, "pattern", "left_semi").select("doc_id", "rid", "s", "e").unionByName(
        unseen.join(known, "t", "left_semi").select("doc_id", "rid", "s", "e")).unionByName(
        valid.select("doc_id", "rid", "s", "e"))
    extra = extra.groupBy("doc_id", "rid").agg(F.collect_set(F.struct(F.lit(4).alias("k"), "s", "e")).alias("extra"))
    return rows.select("doc_id", "rid", "base"), extra


def _with_all(rows: DataFrame, extra: DataFrame) -> DataFrame:
    extra = extra.withColumnRenamed("doc_id", "x_doc").withColumnRenamed("rid", "x_rid")
    out = rows.join(extra, F.col("rid").eqNullSafe(F.col("x_rid")) & F.col("doc_id").eqNullSafe(F.col("x_doc")), "left")
    return out.select("doc_id", "rid", "base",
                      F.expr("concat(base, coalesce(extra, cast(array() as array<struct<k:int,s:int,e:int>>)))").alias("spans"))


def scan(docs: DataFrame, *, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context, n_spans."""
    out = _with_all(*_found(docs, rounds, min_confidence, min_seeds))
    count = [F.expr(f"size(filter(base, x -> x.k = {k}))").cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return out.select("doc_id", *count, F.sha2(shown("base", KINDS, False), 256).alias("base_sha256"),
                      shown("spans", KINDS, False).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_context"),
                      F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, *, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all rows and
    columns are kept, and ``n_chars``, if there, follows the text."""
    found = _with_all(*_found(docs, rounds, min_confidence, min_seeds)).where("size(spans) > 0").dropDuplicates(["doc_id", "rid"])
    found = found.select(F.col("doc_id").alias("_doc"), F.col("rid").alias("_rid"), F.col("spans").alias("_spans"))
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", text_or_empty()))
    out = keyed.join(found, F.col("_key").eqNullSafe(F.col("_rid")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(redacted("text", "_spans", KINDS))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*[f"`{c}`" for c in docs.columns])
