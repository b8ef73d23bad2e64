"""Language identification: counts and limits come from all training rows."""

import zlib

from keelson.llm import language_id

SCHEMA = "doc_id long, text string, lang string"


def _ids(fold, n):
    return [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 == fold][:n]


def _by_lang(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return {r["doc_id"]: r for r in language_id.identify(docs, **options).collect()}


def test_every_training_row_is_counted(spark):
    rows = [(i, "the cat sat on the mat", "en") for k in (0, 1) for i in _ids(k, 20)]
    # words that stand in rows of remainder 3 alone, a few of which any sample would hold
    rows += [(i, "zyxq wvuk", "en") for i in _ids(3, 3)]
    ask = _ids(2, 1)[0]
    out = _by_lang(spark, rows + [(ask, "zyxq wvuk", "en")])
    assert out[ask]["entropy"] < 2.5               # seen; beyond 3 if the rows were left out of the counts


def test_limits_come_from_every_remainder(spark):
    plain, odd = "the cat sat on the mat and the dog sat on the cat", "zyxq wvuk jhgf bnmv"
    rows = [(i, plain, "en") for k in (0, 1, 3) for i in _ids(k, 30)]
    rows += [(i, odd, "en") for i in _ids(0, 31)[30:]]       # an odd row outside remainder 3
    ask = _ids(2, 2)
    out = _by_lang(spark, rows + [(ask[0], plain, "en"), (ask[1], odd, "en")])
    assert out[ask[0]]["accepted"] and out[ask[1]]["accepted"]
