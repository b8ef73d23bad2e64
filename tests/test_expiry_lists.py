"""Reservation expiry: open reservations lie in a fixed number of lists."""

import datetime as dt

from keelson.streaming import jobs as S

T0 = dt.datetime(2024, 1, 1)
EVENTS = "kind string, project string, reservation_id long, agent string, pattern string, exclusive boolean, ts timestamp_ntz, ttl_seconds long"


def test_expiry_keeps_few_lists(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "EXPIRY_BUCKETS", 3)
    rows = [("reserve", "p", 2**60 + i, f"u{i}", "**", True, T0 + dt.timedelta(minutes=i), 600) for i in range(40)]
    rows += [("release", "p", 2**60 + i, f"u{i}", "**", True, T0 + dt.timedelta(minutes=i + 5), None) for i in range(0, 40, 4)]
    rows += [("reserve", "p", None, "u", "**", True, T0, 60), ("reserve", "p", 7, "u", "**", True, T0 + dt.timedelta(days=3), 60)]
    src, home = str(tmp_path / "in"), str(tmp_path / "home")
    for k in range(3):
        spark.createDataFrame(rows[k::3] if k < 2 else rows[2::3] + rows[-1:], EVENTS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EVENTS).parquet(src)
    got = S.with_state_store(spark, lambda: S.run_stream(S.reservation_expiry(stream), "expiry", home=home))
    cols = ["project", "reservation_id", "agent", "start_ts", "expired_ts"]
    want = S.expired_reservations(spark.createDataFrame([r for r in rows if r[2] is not None], EVENTS)).select(*cols).collect()
    assert sorted(map(tuple, got.filter("reservation_id is not null").select(*cols).collect())) == sorted(map(tuple, want))
    assert len(want) == 30 and got.filter("reservation_id is null").count() == 1
    left = spark.read.format("statestore").option("stateVarName", "held").option("flattenCollectionTypes", "true").load(f"{home}/expiry/_checkpoint")
    assert {r["key"]["bucket"] for r in left.collect()} <= {0, 1, 2}
