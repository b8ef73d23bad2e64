"""Secret scan with multipart credential linking [native].

Base spans (assign, access, hex) stand on their own. Besides, a credential is made
of parts: an access identifier, a secret and an endpoint. Parts that are too weak
to report alone (a short assigned value, a short key id, a named login, a short hex
run of letters and digits) are reported only if a complementary part begins within
``SCOPE`` code points of them in the same text: a weak secret needs an access
identifier or an endpoint, a weak access identifier needs a secret.

The link is an interval join: parts are dealt to blocks of ``SCOPE`` code points of
their text (the complement also to the two blocks beside its own), joined on text
and block, and the distance is checked. It is a semi join, so a part is kept once
however many partners it has. Texts are read once; only parts are shuffled.

Cases: a null text is empty; a null doc_id joins itself; rows equal in doc_id and
text are judged alike, each keeps its row; parts that begin at one place are each judged;
a text of very many matches takes time about in proportion (``spans``); other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut, text_or_empty
from keelson.llm.spans import matches, outside, shown, with_pieces

SCOPE = 256
KINDS = ["assign", "access", "hex", "weak_access", "weak_secret"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{12,}+",
    "login": r"""(?<![A-Za-z0-9])(?i:(?:user(?:name)?|login|client_?id|account))["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}+""",
    "endpoint": r"""https?://[A-Za-z0-9.-]++(?::[0-9]++)?|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])""",
}


def _parts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, rid, base (array<struct<k,s,e>>), parts (struct<c,w,s,e>:
    class a, s or e, and the weak kind's place in KINDS or null)."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = with_pieces(rows, PATTERNS).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("rid"), *[matches(k).alias(k) for k in PATTERNS])
    rows = rows.withColumn("assign", F.transform("assign", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.length(F.regexp_extract(x["t"], ASSIGN, 2)).alias("n"))))
    rows = rows.withColumn("base", F.expr("""concat(
        transform(filter(assign, x -> x.n >= 12), x -> named_struct('k', 0, 's', x.s, 'e', x.e)),
        transform(filter(access, x -> x.e - x.s >= 18), x -> named_struct('k', 1, 's', x.s, 'e', x.e)),
        transform(filter(hex, x -> x.e - x.s >= 16), x -> named_struct('k', 2, 's', x.s, 'e', x.e)))"""))
    rows = rows.withColumn("weak", F.expr("""concat(
        transform(filter(access, x -> x.e - x.s between 8 and 17), x -> named_struct('c', 'a', 'w', 3, 's', x.s, 'e', x.e)),
        transform(login, x -> named_struct('c', 'a', 'w', 3, 's', x.s, 'e', x.e)),
        transform(filter(assign, x -> x.n between 6 and 11), x -> named_struct('c', 's', 'w', 4, 's', x.s, 'e', x.e)),
        transform(filter(hex, x -> x.e - x.s < 16 and x.t rlike '[0-9]' and x.t rlike '[a-f]'),
                  x -> named_struct('c', 's', 'w', 4, 's', x.s, 'e', x.e)))"""))
    rows = rows.withColumn("weak", F.expr(outside("weak", "base")))
    return rows.select("doc_id", "rid", "base", F.expr("""if(size(weak) = 0, cast(array() as array<struct<c:string,w:int,s:int,e:int>>),
        concat(weak,
          transform(base, x -> named_struct('c', if(x.k = 1, 'a', 's'), 'w', cast(null as int), 's', x.s, 'e', x.e)),
          transform(endpoint, x -> named_struct('c', 'e', 'w', cast(null as int), 's', x.s, 'e', x.e))))""").alias("parts"))


def _linked(rows: DataFrame, scope: int) -> DataFrame:
    """doc_id, rid, extra: the weak parts of each text that have a complement."""
    parts = rows.where("size(parts) > 0").dropDuplicates(["doc_id", "rid"]).select(
        "doc_id", "rid", F.inline("parts")).withColumn("block", F.expr(f"s div {scope}"))
    weak = parts.where("w is not null").alias("w")
    near = parts.select("doc_id", "rid", "c", "s", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block")).alias("n")
    complement = F.expr("(w.c = 's' and n.c in ('a', 'e')) or (w.c = 'a' and n.c = 's')")
    kept = weak.join(near, F.col("w.rid").eqNullSafe(F.col("n.rid")) & F.col("w.doc_id").eqNullSafe(F.col("n.doc_id"))
                     & (F.col("w.block") == F.col("n.block")) & complement
                     & (F.abs(F.col("w.s") - F.col("n.s")) <= scope), "left_semi")
    return kept.groupBy("doc_id", "rid").agg(F.collect_set(F.struct(F.col("w").alias("k"), "s", "e")).alias("extra"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = cut(_parts(docs))
    extra = _linked(rows, scope).withColumnRenamed("doc_id", "x_doc").withColumnRenamed("rid", "x_rid")
    out = rows.join(extra, F.col("rid").eqNullSafe(F.col("x_rid")) & F.col("doc_id").eqNullSafe(F.col("x_doc")), "left")
    out = out.withColumn("all", F.expr("concat(base, coalesce(extra, cast(array() as array<struct<k:int,s:int,e:int>>)))"))
    count = [F.expr(f"size(filter(base, x -> x.k = {k}))").cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return out.select("doc_id", *count, F.sha2(shown("base", KINDS, True), 256).alias("base_sha256"),
                      shown("all", KINDS, True).alias("spans"), F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_linked"))
