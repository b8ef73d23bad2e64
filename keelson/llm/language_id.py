"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, every run of non-letters becomes one space, and each text
starts after three spaces. A 4-gram of code points is packed into 64 bits (16 per
code point; those beyond the basic plane are folded into its upper half) and mixed
into a hash. Only 4-gram counts are gathered from the corpus: every Kneser-Ney
lower order (number of distinct left neighbours) follows from the set of distinct
4-grams. Each partition counts its own rows, Spark sums the counts, and the model
(all languages in one table of log-probabilities per order) is stored in arrays
sorted by hash, found by binary search.

A text gets the language of the lowest cross-entropy per character. ``score`` is
the tempered posterior of that language. ``accepted`` is a calibrated rejection:
the text's cross-entropy, centred on the language's mean and scaled by the square
root of its length, is at most the ``QUANTILE`` of the same figure on calibration
documents. Training rows are those with crc32(doc_id) mod 4 in (0, 1, 3), and the
counts come from all of them. The limits come from all of them, too: each remainder's
rows are judged by a model of the other two remainders' counts, which has not seen
them, where it knows their language. A language whose rows are all of one remainder
is learned, but its rejection limit has no documents, and then none of those
predicted in it is accepted. Rows of remainder 2 are held out. (With
``calibration_rows``, at most so many rows of remainder 3, the least by hash of doc_id,
set the limits in one pass, and the counts come from all other training rows and from
those of a language that would have no row with a letter left.)

``MAX_ENTRIES`` bounds the model that is collected and broadcast (32 bytes an
entry and language). A larger one stays on Spark with every count: log2 of a
4-gram's probability is the language's floor plus one weight per order in which the
language has the gram's end or context (``Sharded``), so a text's sum is a join of
its distinct m-grams with the weights. Both forms give the same figures.

Cases: a null text or one without a letter is ``und`` with score 0 and not
accepted; a null lang is not learned from; a null doc_id is neither trained on nor
held out; of languages of equal cross-entropy the least name is taken; a very long text is
scored whole by one task; repeated rows count as often as they stand; without any
training text every document is ``und``; an empty table gives no rows; columns besides
doc_id, text and lang are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut, slices, text_or_empty
from keelson.llm.text import mix64
from keelson.operators.scan import percentiles

ORDER = 4
MAX_ENTRIES = 1_000_000
FOLDS = (0, 1, 3)
QUANTILE = 0.999
TEMPERATURE = 12.0
_SPACE = 32
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), dtype=bool, count=1 << 16))
    return _LETTER[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed 4-grams of all texts, first gram of each text + end, has a letter).

    One gram per kept character: letters and single spaces between them."""
    codes = np.frombuffer("\0".join(t.replace("\0", " ").lower() for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    table = _letters()
    high = codes >= (1 << 16)
    letter = table[np.where(high, 0, codes)]
    if high.any():
        kinds, where = np.unique(codes[high], return_inverse=True)
        letter[high] = np.array([chr(c).isalpha() for c in kinds])[where]
    mark = codes == 0
    low = np.where(letter, np.where(high, codes & 0x7FFF | 0x8000, codes), _SPACE).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                        # the first non-letter after a letter: a space
    keep |= mark                                   # text ends (kept as spaces, cut below)
    low, mark = low[keep], mark[keep]
    ends = np.append(np.flatnonzero(mark), len(low))
    starts = np.append(0, ends[:-1] + 1)
    ends = np.maximum(ends, starts)
    n = len(low)
    pos = np.arange(n)
    since = pos - np.repeat(starts, np.append(np.diff(starts), n - starts[-1]))
    packed = low.copy()
    for back in range(1, ORDER):
        prev = np.full(n, _SPACE, dtype=np.uint64)
        prev[back:] = low[:-back] if n > back else prev[back:]
        prev[since < back] = _SPACE
        packed |= prev << np.uint64(16 * back)
    inside = ~mark
    counts = np.add.reduceat(np.append(inside, False), np.minimum(starts, n)).astype(np.int64) if n else np.zeros(len(texts), dtype=np.int64)
    counts[ends <= starts] = 0
    first = np.concatenate([[0], np.cumsum(counts)])
    packed = packed[inside]
    seen = np.append(packed & np.uint64(0xFFFF) != _SPACE, False)
    has = np.zeros(len(texts), dtype=bool)
    some = np.flatnonzero(counts)
    if len(some):
        has[some] = np.logical_or.reduceat(seen, first[:-1][some])
    return packed, first, has


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""
    def run(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(lang):
            parts = held[lang]
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            held[lang] = [(keys, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64))]

        for whole in batches:
            for b in slices(whole, 1):
                by: dict[str, list[str]] = {}
                for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    held.setdefault(lang, []).append(np.unique(grams(texts)[0], return_counts=True))
                    if len(held[lang]) > 16:
                        merge(lang)
        for lang in held:
            merge(lang)
            keys, n = held[lang][0]
            for at in range(0, len(keys), 1 << 16):
                part = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part.view(np.int64)), pa.array(n[at:at + (1 << 16)])],
                    names=["lang", "gram", "n"])
    return train.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def _totals(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, where = np.unique(keys, return_inverse=True)
    return kinds, np.bincount(where, values, minlength=len(kinds))


def _discount(n: np.ndarray) -> float:
    return _discount_of(float((n == 1).sum()), float((n == 2).sum()))


def _discount_of(one: float, two: float) -> float:
    return min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5


class Model:
    """Kneser-Ney models of all languages, one set of sorted arrays per order.

    ``keys[m]`` are the sorted hashes of the m-grams seen in any language and
    ``logs[m]`` their log2-probability in each; ``contexts[m]`` and ``backs[m]``
    are the same for the weight that a context of m characters leaves to the
    shorter order (0 where the context is unseen)."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        mask = [np.uint64((1 << (16 * m)) - 1) for m in range(ORDER + 1)]
        found: dict[int, list] = {m: [] for m in range(1, ORDER + 1)}
        back: dict[int, list] = {m: [] for m in range(1, ORDER)}
        self.floor = np.zeros(len(self.langs))
        alphabet = len(np.unique(np.concatenate([k & mask[1] for k, _ in counts.values()]))) + 1 if counts else 1
        for at, lang in enumerate(self.langs):
            grams_of = {ORDER: tuple(counts[lang])}
            for m in range(ORDER - 1, 0, -1):      # distinct left neighbours
                longer = grams_of[m + 1][0]
                kinds, n = np.unique(longer & mask[m], return_counts=True)
                grams_of[m] = (kinds, n.astype(np.float64))
            kinds, n = grams_of[1]
            d, total = _discount(n), n.sum()
            self.floor[at] = np.log2(d * len(n) / total / alphabet)
            prob = {1: (kinds, (n - d) / total + d * len(n) / total / alphabet)}
            for m in range(2, ORDER + 1):
                kinds, n = grams_of[m]
                d = _discount(n)
                context = kinds >> np.uint64(16)
                ctx, total = _totals(context, n)
                _, types = _totals(context, np.ones(len(n)))
                left = d * types / total
                which = np.searchsorted(ctx, context)
                lower_keys, lower = prob[m - 1]
                low = lower[np.searchsorted(lower_keys, kinds & mask[m - 1])]
                prob[m] = (kinds, np.maximum(n - d, 0) / total[which] + left[which] * low)
                back[m - 1].append((at, ctx, np.log2(left)))
            for m in prob:
                found[m].append((at, prob[m][0], np.log2(prob[m][1])))
        self.contexts, self.backs = {}, {}
        for m, parts in back.items():
            self.contexts[m], self.backs[m] = self._table(parts, 0.0)
        self.keys, self.logs = {}, {}
        for m in range(1, ORDER + 1):
            plain = np.unique(np.concatenate([k for _, k, _ in found[m]])) if found[m] else np.zeros(0, dtype=np.uint64)
            if m == 1:
                values = np.repeat(self.floor[None, :], len(plain), axis=0)
            else:                                  # unseen in a language: back off there
                values = self._lookup(m - 1, plain & mask[m - 1]) + self._back(m - 1, plain >> np.uint64(16))
            for at, k, v in found[m]:
                values[np.searchsorted(plain, k), at] = v
            order = np.argsort(mix64(plain))
            self.keys[m], self.logs[m] = mix64(plain)[order], values[order].astype(np.float32)
        self.mask = mask

    def _table(self, parts, empty):
        if not parts:
            return np.zeros(0, dtype=np.uint64), np.zeros((0, len(self.langs)), dtype=np.float32)
        plain = np.unique(np.concatenate([k for _, k, _ in parts]))
        values = np.full((len(plain), len(self.langs)), empty)
        for at, k, v in parts:
            values[np.searchsorted(plain, k), at] = v
        order = np.argsort(mix64(plain))
        return mix64(plain)[order], values[order].astype(np.float32)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), dtype=bool)

    def _back(self, m: int, context: np.ndarray) -> np.ndarray:
        at, hit = self._find(self.contexts[m], mix64(context))
        return np.where(hit[:, None], self.backs[m][at], np.float32(0))

    def _lookup(self, m: int, packed: np.ndarray) -> np.ndarray:
        """log2-probabilities of m-grams in every language, backing off as needed."""
        at, hit = self._find(self.keys[m], mix64(packed))
        out = self.logs[m][at] if len(self.logs[m]) else np.zeros((len(packed), len(self.langs)), dtype=np.float32)
        miss = np.flatnonzero(~hit)
        if len(miss):
            gram = packed[miss]
            if m == 1:
                out[miss] = self.floor
            else:
                out[miss] = self._lookup(m - 1, gram & np.uint64((1 << (16 * (m - 1))) - 1)) + self._back(m - 1, gram >> np.uint64(16))
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy per character and language, characters, has a letter)."""
        packed, first, has = grams(texts)
        n = np.diff(first)
        out = np.full((len(texts), len(self.langs)), np.inf)
        some = np.flatnonzero(n)
        if len(some) and self.langs:
            logs = self._lookup(ORDER, packed)
            sums = np.stack([np.add.reduceat(logs[:, j], first[:-1][some], dtype=np.float64) for j in range(len(self.langs))], axis=1)
            out[some] = -sums / n[some][:, None]
        return out, n, has


class Sharded:
    """The models of all languages as tables, for any number of entries.

    ``weights`` has a row (m, gram, lang, ending, leading) per m-gram and language:
    ``ending`` is what log2-probability gains over backing off where the language has
    the m-gram, ``leading`` the log2-weight it leaves as a context. An m-gram's end and
    context are seen wherever it is, so those that a language lacks add nothing and
    the sum over orders is the backed-off value. ``floors`` holds (lang, floor)."""

    def __init__(self, counts: DataFrame):
        spark = counts.sparkSession
        grams_of = {ORDER: counts.select("lang", "gram", F.col("n").cast("double").alias("n"))}
        for m in range(ORDER - 1, 0, -1):          # distinct left neighbours
            grams_of[m] = cut(grams_of[m + 1].groupBy("lang", _end("gram", m).alias("gram")).agg(
                F.count("*").cast("double").alias("n")))
        alphabet = grams_of[1].select("gram").distinct().count() + 1
        # one row per language and order
        figures = [grams_of[m].groupBy("lang").agg(
            F.lit(m).alias("m"), F.sum((F.col("n") == 1).cast("long")).alias("one"), F.sum((F.col("n") == 2).cast("long")).alias("two"),
            F.sum("n").alias("total"), F.count("*").alias("kinds")).collect() for m in range(1, ORDER + 1)]
        discounts = {m: spark.createDataFrame([(r["lang"], _discount_of(r["one"], r["two"])) for r in rows], "lang string, d double")
                     for m, rows in enumerate(figures, 1)}
        shares = []
        for r in figures[0]:
            rest = _discount_of(r["one"], r["two"]) * r["kinds"] / r["total"] / alphabet
            shares.append((r["lang"], float(r["total"]), float(rest), float(np.log2(rest))))
        floors = spark.createDataFrame(shares, "lang string, total double, rest double, floor double")
        self.floors = floors.select("lang", "floor")
        self.langs = sorted(r[0] for r in shares)
        prob = cut(grams_of[1].join(F.broadcast(discounts[1]), "lang").join(F.broadcast(floors), "lang").select(
            "lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("rest")).alias("p"), "floor"))
        parts = [prob.select(F.lit(1).alias("m"), "gram", "lang", (F.log2("p") - F.col("floor")).alias("ending"), F.lit(0.0).alias("leading"))]
        prob = prob.select("lang", "gram", "p")
        for m in range(2, ORDER + 1):
            rows = grams_of[m].join(F.broadcast(discounts[m]), "lang").select(
                "lang", "gram", "n", "d", F.shiftrightunsigned("gram", 16).alias("context"), _end("gram", m - 1).alias("end"))
            left = rows.groupBy("lang", "context").agg(
                F.sum("n").alias("total"), (F.first("d") * F.count("*") / F.sum("n")).alias("left"))
            lower = prob.select("lang", F.col("gram").alias("end"), F.col("p").alias("lower"))
            prob = cut(rows.join(left, ["lang", "context"]).join(lower, ["lang", "end"]).select(
                "lang", "gram", "context", "left", "lower",
                (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("left") * F.col("lower")).alias("p")))
            parts.append(prob.select(F.lit(m).alias("m"), "gram", "lang", (F.log2("p") - F.log2("left") - F.log2("lower")).alias("ending"),
                                     F.lit(0.0).alias("leading")))
            parts.append(prob.groupBy("lang", "context").agg(F.first("left").alias("left")).select(
                F.lit(m - 1).alias("m"), F.col("context").alias("gram"), "lang", F.lit(0.0).alias("ending"), F.log2("left").alias("leading")))
            prob = prob.select("lang", "gram", "p")
        weights = parts[0]
        for part in parts[1:]:
            weights = weights.unionByName(part)
        self.weights = cut(weights.groupBy("m", "gram", "lang").agg(F.sum("ending").alias("ending"), F.sum("leading").alias("leading")))

    def entropies(self, texts: DataFrame) -> DataFrame:
        """Per distinct text (id, text): id, n, has, lang, low, score."""
        spans = texts.mapInArrow(_features, "id binary, m int, gram long, ending long, leading long")
        spans = spans.where("m > 0").join(self.weights.withColumnsRenamed({"ending": "w_ending", "leading": "w_leading"}), ["m", "gram"])
        sums = spans.select("id", "lang", (F.col("ending") * F.col("w_ending") + F.col("leading") * F.col("w_leading")).alias("log"))
        whole = texts.mapInArrow(_features, "id binary, m int, gram long, ending long, leading long").where("m = 0")
        whole = whole.select("id", F.col("ending").alias("n"), (F.col("leading") > 0).alias("has"))
        base = whole.where("has").crossJoin(F.broadcast(self.floors)).select("id", "lang", (F.col("n") * F.col("floor")).alias("log"))
        each = base.unionByName(sums).groupBy("id", "lang").agg(F.sum("log").alias("log"))
        each = each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("log")).alias("h"), "lang"))).alias("all"))
        out = whole.join(each, "id", "left")
        low = F.col("all")[0]["h"] / F.col("n")
        gaps = F.aggregate("all", F.lit(0.0), lambda a, x: a + F.pow(F.lit(2.0), -TEMPERATURE * (x["h"] / F.col("n") - low)))
        return out.select("id", "n", F.coalesce(F.col("all")[0]["lang"], F.lit("und")).alias("lang_pred"), low.alias("entropy"),
                          F.coalesce(1 / gaps, F.lit(0.0)).alias("score"))


def _end(gram: str, m: int):
    return F.col(gram).bitwiseAND(F.lit((1 << (16 * m)) - 1))


def _features(batches):
    """(id, m, gram, times as an end, times as a context) per text and m-gram; the
    row with m = 0 has the text's length and whether it has a letter."""
    for whole in batches:
        for b in slices(whole, 1, 1 << 18):
            packed, first, has = grams(b.column(1).to_pylist())
            row = np.repeat(np.arange(b.num_rows), np.diff(first))
            parts = [(np.arange(b.num_rows), 0, np.zeros(b.num_rows, dtype=np.uint64), np.diff(first), has.astype(np.int64))]
            for m in range(1, ORDER + 1):
                mask = np.uint64((1 << (16 * m)) - 1)
                ends = packed & mask
                leads = packed >> np.uint64(16) & mask if m < ORDER else packed[:0]
                rows, keys = np.concatenate([row, row[:len(leads)]]), np.concatenate([ends, leads])
                order = np.lexsort((keys, rows))
                rows, keys, is_end = rows[order], keys[order], order < len(ends)
                if not len(rows):
                    continue
                at = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])))
                ending = np.add.reduceat(is_end.astype(np.int64), at)
                parts.append((rows[at], m, keys[at], ending, np.diff(np.append(at, len(rows))) - ending))
            for rows, m, keys, ending, leading in parts:
                for k in range(0, len(rows), 1 << 16):
                    to = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(rows[to])), pa.array(np.full(len(rows[to]), m, dtype=np.int32)),
                         pa.array(keys[to].view(np.int64)), pa.array(ending[to]), pa.array(leading[to])],
                        names=["id", "m", "gram", "ending", "leading"])


def fit(train: DataFrame, max_entries: int = MAX_ENTRIES) -> Model | Sharded:
    """Model of the languages of ``train`` (lang, text), from all its rows."""
    return _model(cut(gram_counts(train)), max_entries)


def _model(counts: DataFrame, max_entries: int) -> Model | Sharded:
    if counts.count() > max_entries:
        return Sharded(counts)
    rows = counts.toPandas()
    by = {}
    for lang, part in rows.groupby("lang"):
        part = part.assign(gram=part["gram"].to_numpy().view(np.uint64)).sort_values("gram")
        by[lang] = (part["gram"].to_numpy(), part["n"].to_numpy().astype(np.float64))
    return Model(by)


def _score(model, limits, names, extra):
    def run(batches):
        m, cal = model.value, limits
        for whole in batches:
            for b in slices(whole, 1, 1 << 20):
                h, n, has = m.entropies(b.column(1).to_pylist())
                has &= np.isfinite(h).all(axis=1) & (len(m.langs) > 0)
                if len(m.langs):
                    best = h.argmin(axis=1)
                    low = np.where(has, h.min(axis=1), 0.0)
                    gap = np.where(has[:, None], h - low[:, None], 0.0)
                    score = np.where(has, 1 / np.exp2(-TEMPERATURE * gap).sum(axis=1), 0.0)
                    lang = [m.langs[x] if ok else "und" for x, ok in zip(best, has)]
                else:
                    low, score, lang = np.zeros(len(n)), np.zeros(len(n)), ["und"] * len(n)
                ok = [bool(y) and (v - cal[x][0]) * np.sqrt(c) <= cal[x][1] if x in cal else False
                      for x, y, v, c in zip(lang, has, low, n)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in extra), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(np.where(has, low, np.nan), pa.float64(), from_pandas=True), pa.array(n, pa.int64()), pa.array(ok, pa.bool_())],
                    names=names)
    return run


def predict(docs: DataFrame, model, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """doc_id, lang_pred, score, entropy, n_letters, accepted per row; ``model`` is a
    Sharded or a broadcast Model."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    if isinstance(model, Sharded):
        return _predict_sharded(rows, model, limits)
    names = ["doc_id", "lang_pred", "score", "entropy", "n_letters", "accepted"]
    return rows.mapInArrow(
        _score(model, limits, names, [0]),
        f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double, entropy double, n_letters long, accepted boolean")


def _predict_sharded(rows: DataFrame, model: Sharded, limits: dict[str, tuple[float, float]]) -> DataFrame:
    spark = rows.sparkSession
    keyed = rows.withColumn("id", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    found = model.entropies(keyed.select("id", "text").dropDuplicates(["id"]))
    bounds = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in limits.items()], "lang_pred string, mean double, bound double")
    out = keyed.select("doc_id", "id").join(found, "id").join(F.broadcast(bounds), "lang_pred", "left")
    # sums come in any order: a text that is itself the limit stays accepted
    ok = (F.col("entropy") - F.col("mean")) * F.sqrt("n") <= F.col("bound") + 1e-9
    return out.select("doc_id", "lang_pred", "score", "entropy", F.col("n").alias("n_letters"), F.coalesce(ok, F.lit(False)).alias("accepted"))


def calibrate(found: DataFrame) -> dict[str, tuple[float, float]]:
    """Per language (mean cross-entropy, limit of the centred and scaled figure) of the
    predictions ``found`` (``predict``). The limits are found over ranges, so no task holds
    a language's rows."""
    found = cut(found.where("lang_pred <> 'und'").select("lang_pred", "entropy", "n_letters"))
    means = {r[0]: r[1] for r in found.groupBy("lang_pred").agg((F.sum(F.col("entropy") * F.col("n_letters")) / F.sum("n_letters"))).collect()}
    if not means:
        return {}
    mean = F.element_at(F.create_map(*[F.lit(x) for kv in means.items() for x in kv]), F.col("lang_pred"))
    scaled = found.groupBy("lang_pred", ((F.col("entropy") - mean) * F.sqrt("n_letters")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    tails = percentiles(cut(scaled), ["lang_pred"], "v", "n", {"q": QUANTILE})
    return {r["lang_pred"]: (means[r["lang_pred"]], r["q"]) for r in tails.collect()}


def _shared(docs: DataFrame, model):
    return docs.sparkSession.sparkContext.broadcast(model) if isinstance(model, Model) else model


def _learn(known: DataFrame, max_entries: int):
    """(model, limits) from all rows of ``known`` (doc_id, text, lang, fold). Grams are
    counted once, by remainder; the models are sums of these counts."""
    apart = cut(gram_counts(known.select(F.concat(F.col("fold").cast("string"), "lang").alias("lang"), "text")).select(
        F.substring("lang", 1, 1).cast("int").alias("fold"), F.expr("substr(lang, 2)").alias("lang"), "gram", "n"))

    def summed(rows):
        return _model(cut(rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))), max_entries)
    found = []
    for fold in FOLDS:
        rest = summed(apart.where(F.col("fold") != fold))
        unseen = known.where((F.col("fold") == fold) & F.col("lang").isin(rest.langs))
        found.append(cut(predict(unseen, _shared(known, rest), {}).select("lang_pred", "entropy", "n_letters")))
    return summed(apart), calibrate(found[0].unionByName(found[1]).unionByName(found[2]))


def _learn_by_sample(rows: DataFrame, known: DataFrame, max_entries: int, calibration_rows: int):
    # the sample is chosen by id alone: the texts of each partition's candidates stay where they are
    chosen = rows.where("fold = 3 and lang is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(calibration_rows)
    chosen = cut(chosen.distinct()).select("doc_id", F.lit(True).alias("sampled"))
    known = known.join(F.broadcast(chosen), "doc_id", "left").withColumn("sampled", F.coalesce("sampled", F.lit(False)))
    learnable = known.where(r"text rlike '\\p{L}'").groupBy("lang").agg(F.min("sampled").alias("bare"))
    # one row per language
    known = known.join(F.broadcast(cut(learnable.where("bare"))), "lang", "left").withColumn(
        "sampled", F.col("sampled") & F.col("bare").isNull())
    model = fit(known.where("not sampled"), max_entries)
    return model, calibrate(predict(known.where("sampled"), _shared(known, model), {}))


def identify(docs: DataFrame, *, max_entries: int = MAX_ENTRIES, calibration_rows: int | None = None) -> DataFrame:
    """Train on all rows of ``docs`` that are not held out and judge all rows."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rows = docs.select("doc_id", "text", "lang", fold.alias("fold"))
    known = rows.where("text is not null and lang is not null and fold in (0, 1, 3)")
    if calibration_rows is None:
        model, limits = _learn(known, max_entries)
    else:
        model, limits = _learn_by_sample(rows, known, max_entries, calibration_rows)
    out = predict(docs, _shared(docs, model), limits)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "entropy", "accepted")
