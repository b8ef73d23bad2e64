"""Character spans of regular-expression matches, as DataFrame expressions.

Spark has no function that returns the positions of all matches. Here every match
is put between two marks by ``regexp_replace`` and the text is split at the marks:
odd pieces are matches, and the lengths of the pieces before give the positions
(code points, end exclusive). The mark U+0001 of the text itself is read as U+0002;
neither is in a character class of the patterns, and lengths stay the same.

Long texts and texts of very many matches take time about in proportion: runs of the
patterns are possessive, and a run that can't match from its start is not tried again from
its middle; running sums go over blocks of ``BLOCK`` entries (each block starts from the
sum of the blocks before), so no array grows with the text; and parts of a text are taken
from chunks of ``CHUNK`` code points, as a ``substring`` walks there from the text's start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u0001"
SPAN = "struct<s:int,e:int,t:string>"
BLOCK = 64             # entries of an array whose running sums are taken together
CHUNK = 1024           # code points of a chunk of text
FEW = 4096             # products of two arrays' sizes that are compared pair by pair


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def with_pieces(df: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """Add one array of pieces per pattern, named ``_p_<kind>``. The text is read
    through ``translate`` once per pattern; each array is computed once, as the
    next step refers to it by name."""
    plain = F.translate(F.col(text), MARK, "\u0002")
    return df.select("*", *[
        F.split(F.regexp_replace(plain, F.lit(p), F.lit(f"{MARK}$0{MARK}")), MARK, -1).alias(f"_p_{kind}")
        for kind, p in patterns.items()])


def matches(kind: str) -> Column:
    """array<struct<s,e,t>> of the matches in ``_p_<kind>``, by start."""
    p = f"_p_{kind}"
    block = f"""aggregate(sequence({BLOCK} * b, least({BLOCK} * (b + 1), n) - 1),
        named_struct('pos', aggregate(slice(sums, 1, b), 0, (u, v) -> u + v), 'out', cast(array() as array<{SPAN}>)),
        (a, i) -> named_struct(
          'pos', a.pos + lens[2 * i] + lens[2 * i + 1],
          'out', concat(a.out, array(named_struct('s', a.pos + lens[2 * i], 'e', a.pos + lens[2 * i] + lens[2 * i + 1],
                                                  't', {p}[2 * i + 1])))),
        a -> a.out)"""
    sums = f"transform(sequence(0, (n - 1) div {BLOCK}), b -> aggregate(slice(lens, cast({2 * BLOCK} * b + 1 as int), {2 * BLOCK}), 0, (u, v) -> u + v))"
    blocks = f"flatten(transform(sequence(0, cast((n - 1) div {BLOCK} as int)), b -> {block}))"
    whole = let("n", f"cast((size({p}) - 1) / 2 as int)", let("lens", f"transform({p}, x -> length(x))", let("sums", sums, blocks)))
    return F.expr(f"if(size({p}) < 3, cast(array() as array<{SPAN}>), {whole})")


def outside(items: str, spans: str) -> str:
    """SQL: the entries of ``items`` that overlap none of ``spans`` (both arrays of structs
    with s and e). Few are compared pair by pair; of many, both are put in one order
    (spans by start, items by end) in which the greatest end of the spans before an item
    tells whether one reaches into it."""
    pairs = f"filter({items}, x -> not exists({spans}, b -> b.s < x.e and x.s < b.e))"
    events = f"""array_sort(concat(
        transform({spans}, b -> named_struct('k', b.s, 'o', 1, 's', b.s, 'e', b.e, 'i', -1)),
        transform({items}, (x, i) -> named_struct('k', x.e, 'o', 0, 's', x.s, 'e', x.e, 'i', i))))"""
    blocks = f"transform(sequence(0, size(ev) - 1, {BLOCK}), o -> slice(ev, o + 1, {BLOCK}))"
    tops = "transform(blk, z -> aggregate(z, -1, (a, y) -> if(y.o = 1, greatest(a, y.e), a)))"
    free = """flatten(transform(blk, (z, b) -> """ + let("m0", "aggregate(slice(tops, 1, b), -1, (a, y) -> greatest(a, y))", """
        transform(filter(transform(z, (y, j) -> named_struct('o', y.o, 's', y.s, 'i', y.i,
            'm', if(y.o = 0, aggregate(slice(z, 1, j), m0, (a, v) -> if(v.o = 1, greatest(a, v.e), a)), 0))),
          y -> y.o = 0 and y.m <= y.s), y -> y.i)""") + "))"
    swept = let("ev", events, let("blk", blocks, let("tops", tops, f"transform(array_sort({free}), i -> {items}[i])")))
    return f"""case when size({items}) = 0 or size({spans}) = 0 then {items}
        when cast(size({items}) as bigint) * size({spans}) <= {FEW} then {pairs} else {swept} end"""


def chunks(text: str) -> str:
    """SQL: the text in chunks of ``CHUNK`` code points."""
    return f"if(length({text}) <= {CHUNK}, array({text}), regexp_extract_all({text}, '(?s).{{1,{CHUNK}}}', 0))"


def part(pieces: str, a: str, b: str) -> str:
    """SQL: code points ``a`` to ``b`` (exclusive) of the text that ``chunks`` cut up; ``b`` may
    lie behind its end."""
    i, j = (f"cast({v} div {CHUNK} as int)" for v in ("p0", "p1"))       # the chunks of both ends
    one = f"substring(get({pieces}, {i}), p0 % {CHUNK} + 1, p1 - p0)"
    more = f"""concat(substring(get({pieces}, {i}), p0 % {CHUNK} + 1), array_join(slice({pieces}, {i} + 2, {j} - {i} - 1), ''),
        coalesce(substring(get({pieces}, {j}), 1, p1 % {CHUNK}), ''))"""
    body = f"if(p1 <= p0 or {i} >= size({pieces}), '', if({i} = {j}, {one}, {more}))"
    return let("p0", f"cast({a} as int)", let("p1", f"least(cast({b} as int), size({pieces}) * {CHUNK})", body))


def shown(spans: str, kinds: list[str], by_start: bool) -> Column:
    """``kind:start:end`` of an array of struct<k,s,e>, comma-joined; k is the
    place of the kind in ``kinds``."""
    names = ", ".join(f"'{k}'" for k in kinds)
    key = "named_struct('a', x.s, 'b', x.k, 'c', x.e)" if by_start else "named_struct('a', x.k, 'b', x.s, 'c', x.e)"
    start, kind = ("x.a", "x.b") if by_start else ("x.b", "x.a")
    return F.expr(f"""array_join(transform(array_sort(transform({spans}, x -> {key})),
        x -> concat(array({names})[{kind}], ':', {start}, ':', x.c)), ',')""")


def redacted(text: str, spans: str, kinds: list[str]) -> Column:
    """The text with every span (struct<k,s,e>) replaced by ``[KIND]``; spans that
    overlap share the mark of the first."""
    names = ", ".join(f"'[{k.upper()}]'" for k in kinds)
    # per span, the greatest end of those before it: up to there the text is out already
    ordered = f"array_sort(transform({spans}, x -> named_struct('s', x.s, 'e', x.e, 'k', x.k)))"
    blocks = f"transform(sequence(0, size(ev) - 1, {BLOCK}), o -> slice(ev, o + 1, {BLOCK}))"
    tops = "transform(blk, z -> aggregate(z, 0, (a, y) -> greatest(a, y.e)))"
    before = "flatten(transform(blk, (z, b) -> " + let("m0", "aggregate(slice(tops, 1, b), 0, (a, y) -> greatest(a, y))", """
        transform(z, (y, j) -> named_struct('s', y.s, 'k', y.k, 'm', aggregate(slice(z, 1, j), m0, (a, v) -> greatest(a, v.e))))""") + "))"
    kept = f"transform(filter({before}, v -> v.s >= v.m), v -> concat({part('cs', 'v.m', 'v.s')}, array({names})[v.k]))"
    tail = part("cs", "array_max(tops)", f"size(cs) * {CHUNK}")
    body = let("ev", ordered, let("blk", blocks, let("tops", tops, let("cs", chunks(text), f"concat(array_join({kept}, ''), {tail})"))))
    return F.expr(f"if(size({spans}) = 0, {text}, {body})")
