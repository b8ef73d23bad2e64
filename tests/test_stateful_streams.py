"""Event-time timers (reservation expiry, review load) on files that come in any order, and the
versioned upsert table under replays, a broken batch and a concurrent reader."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import coord as M
from keelson.streaming import jobs as S
from keelson.streaming.versions import VersionedTable

T0 = dt.datetime(2024, 1, 1)
MSG = "project string, msg_id long, thread_id string, from_agent string, subject string, body string, ts timestamp_ntz"
RES = "kind string, project string, reservation_id long, agent string, pattern string, exclusive boolean, ts timestamp_ntz, ttl_seconds long"


def _files(spark, rows, schema, path, n):
    """``rows`` in ``n`` files, one micro-batch each."""
    for k in range(n):
        spark.createDataFrame(rows[k::n], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _message(i, minutes, agent, claim):
    return ("p", i, f"t-{i}-review", agent, "Review In Progress" if claim else "Review Complete: Approved", "", T0 + dt.timedelta(minutes=minutes))


def _sorted(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_load_alarm_in_event_order(spark, tmp_path):
    """Events of 50 minutes dealt to four files at random, then two that move the watermark."""
    rng = random.Random(5)
    rows = [_message(i, rng.random() * 50, f"u{rng.randint(0, 2)}", rng.random() < 0.6) for i in range(60)]
    rng.shuffle(rows)
    src, home = str(tmp_path / "in"), str(tmp_path / "home")
    _files(spark, rows, MSG, src, 4)
    late = [_message(100, 600, "u9", True), _message(101, 60 * 24 * 40, "u9", False)]
    for r in late:
        stream = _files(spark, [r], MSG, src, 1)
    got = S.with_state_store(spark, lambda: S.run_stream(S.review_load_alarm(stream, cap=1), "load", home=home))
    whole = spark.createDataFrame(rows + late, MSG)
    cols = ["agent", "msg_id", "ts", "load"]
    want = _sorted(S.passed_load_alarms(whole, cap=1), cols)
    assert _sorted(got, cols) == want and len(want) > 5
    plain = _sorted(M.review_load(whole, cap=1).withColumn("ts", F.col("ts").cast("timestamp")), cols)
    assert want == plain                           # the spells without events are at the ends
    left = spark.read.format("statestore").option("stateVarName", "load").load(f"{home}/load/_checkpoint")
    assert {r["key"]["agent"] for r in left.collect()} <= {"u9"}      # idle agents leave none


def test_completions_that_come_late_raise_no_alarm(spark, tmp_path):
    first = [_message(i, m, "u1", True) for i, m in enumerate((1, 2, 3, 10, 11))]
    second = [_message(10, 5, "u1", False), _message(11, 6, "u1", False)]
    src = str(tmp_path / "in")
    _files(spark, first, MSG, src, 1)
    _files(spark, second, MSG, src, 1)
    stream = _files(spark, [_message(99, 300, "u2", True)], MSG, src, 1)
    got = S.with_state_store(spark, lambda: S.run_stream(S.review_load_alarm(stream, cap=3), "late", home=str(tmp_path / "h")))
    assert got.count() == 0


def test_an_idle_agent_starts_anew(spark):
    rows = [_message(i, i, "u1", True) for i in range(3)] + [_message(10 + i, 60 * 24 * 50 + i, "u1", True) for i in range(2)]
    df = spark.createDataFrame(rows, MSG)
    assert _sorted(M.review_load(df, cap=0, idle_days=30), ["msg_id", "load"]) == [(0, 1), (1, 2), (2, 3), (10, 1), (11, 2)]
    assert _sorted(M.review_load(df, cap=4), ["msg_id", "load"]) == [(11, 5)]


def _reserve(i, hours, ttl_hours, agent="u1"):
    return ("reserve", "p", i, agent, f"src/{i}/**", True, T0 + dt.timedelta(hours=hours), int(ttl_hours * 3600))


def _release(i, hours, agent="u1"):
    return ("release", "p", i, agent, f"src/{i}/**", True, T0 + dt.timedelta(hours=hours), None)


def test_reservations_run_out(spark, tmp_path):
    rows = [_reserve(1, 0, 2), _reserve(2, 0, 5), _release(2, 1), _release(3, 4), _reserve(3, 1, 9), _reserve(4, 2, 1), _release(4, 3.5),
            _reserve(5, 3, 1), _reserve(5, 3, 2), _release(6, 2), _reserve(7, 3, 1), _release(7, 4), _reserve(8, 5, 1000)]
    src, home = str(tmp_path / "in"), str(tmp_path / "home")
    _files(spark, rows, RES, src, 4)
    stream = _files(spark, [_reserve(90, 100, 1)], RES, src, 1)
    stream = _files(spark, [_reserve(91, 10, 1)], RES, src, 1)         # later than the watermark: dropped
    got = S.with_state_store(spark, lambda: S.run_stream(S.reservation_expiry(stream), "expiry", home=home))
    cols = ["project", "reservation_id", "agent", "pattern", "start_ts", "expired_ts"]
    want = _sorted(S.expired_reservations(spark.createDataFrame(rows + [_reserve(90, 100, 1)], RES)), cols)
    assert _sorted(got, cols) == want
    assert [r[1] for r in want] == [1, 4, 5, 7]    # 2 and 3 were given back, 8 and 90 still run, 6 was never taken
    assert next(r for r in want if r[1] == 5)[5].hour == 5


ROWS = "k long, v long"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)


def _state(df):
    return dict(tuple(r) for r in df.collect())


def test_versions_replace_and_replay(spark, table):
    assert table.read() is None
    table.upsert(spark.createDataFrame([(i, 0) for i in range(10)], ROWS), 0)
    batch = spark.createDataFrame([(3, 1), (20, 1)], ROWS)
    table.upsert(batch, 1)
    want = {**{i: 0 for i in range(10)}, 3: 1, 20: 1}
    assert _state(table.read()) == want
    table.upsert(batch, 1)                         # run again after its version is there
    assert table.versions() == [0, 1] and _state(table.read()) == want
    assert _state(table.read(0)) == {i: 0 for i in range(10)}
    table.upsert(batch.limit(0), 2)
    assert _state(table.read()) == want
    for k in range(3, 8):
        table.upsert(spark.createDataFrame([(3, k)], ROWS), k)
    table.vacuum(keep=2)
    assert table.versions() == [6, 7] and _state(table.read()) == {**want, 3: 7} and _state(table.read(6)) == {**want, 3: 6}


def test_versions_combine(spark, table):
    def add(rows):
        return rows.groupBy("k").agg(F.sum("v").alias("v"))
    table.upsert(spark.createDataFrame([], ROWS), 0, add)
    assert _state(table.read()) == {}
    for b in (1, 2, 2, 3):
        table.upsert(spark.createDataFrame([(1, 1), (1, 1), (b, 5)], ROWS), b, add)
    assert _state(table.read()) == {1: 6 + 5, 2: 5, 3: 5}


def test_a_batch_that_breaks_leaves_the_last_version(spark, table, monkeypatch):
    table.upsert(spark.createDataFrame([(1, 1), (2, 1)], ROWS), 0)
    reader = table.read()                          # planned before the next batch
    batch = spark.createDataFrame([(1, 2), (5, 2)], ROWS)
    commit = VersionedTable._commit

    def dies(self, version, manifest):
        raise RuntimeError("killed between write and commit")
    monkeypatch.setattr(VersionedTable, "_commit", dies)
    with pytest.raises(RuntimeError):
        table.upsert(batch, 1)
    assert _state(table.read()) == {1: 1, 2: 1}
    monkeypatch.setattr(VersionedTable, "_commit", commit)
    table.upsert(batch, 1)                         # run again
    assert _state(table.read()) == {1: 2, 2: 1, 5: 2}
    assert _state(reader) == {1: 1, 2: 1}          # still the whole version it began with
