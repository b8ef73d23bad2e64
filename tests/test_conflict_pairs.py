"""Reservation conflicts: pairs leave the join as results."""

import datetime as dt
import random

import pytest

from keelson.operators import coord as M
from keelson.operators.globs import overlap

T0 = dt.datetime(2024, 1, 1)
RES = "project string, reservation_id long, agent string, pattern string, exclusive boolean, start_ts timestamp_ntz, ttl_seconds long"


def test_conflicts_are_not_shuffled(spark):
    rows = [("p", i, f"u{i % 3}", p, True, T0, 60 * i) for i, p in enumerate(["src/**", "src/a.py", "src/*.py", "**", "docs/x.md", "src/b/**"], 1)]
    out = M.reservation_conflicts(spark.createDataFrame(rows + rows[:2], RES))      # rows that stand twice count once
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan.split("Join")[0]
    want = {(1, 2), (1, 3), (1, 6), (2, 3), (2, 4), (3, 4), (4, 5), (4, 6)}
    want = {(a, b) for a, b in want if a % 3 != b % 3}
    assert sorted((r["res_a"], r["res_b"]) for r in out.collect()) == sorted(want)


def test_a_repeated_reservation_has_each_pair_once(spark):
    rows = [("p", 1, "u1", "src/a*b*c", True, T0, 600), ("p", 1, "u1", "src/a*", True, T0, 900), ("p", 1, "u1", "src/*", True, T0, 7),
            ("p", 2, "u2", "src/axc", True, T0, 600), ("p", 3, "u3", "docs/**", True, T0, 600)]
    got = [(r["res_a"], r["res_b"]) for r in M.reservation_conflicts(spark.createDataFrame(rows, RES)).collect()]
    assert got == [(1, 2)]


def _listed(plan) -> int:
    """Rows that the explodes of a plan that has run gave."""
    name = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else \
        [plan.child()] if name == "ReusedExchangeExec" else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("numOutputRows").value() if name == "GenerateExec" else 0
    return own + sum(_listed(p) for p in inner)


def test_a_reservation_is_listed_in_few_places(spark):
    rows = [("p", i, f"u{i}", f"src/a/b/m{i}/**", True, T0 + dt.timedelta(minutes=7 * i), 60 * 2 ** (i % 9)) for i in range(450)]
    out = M.reservation_conflicts(spark.createDataFrame(rows, RES))
    assert out.collect() == []
    assert 0 < _listed(out._jdf.queryExecution().executedPlan()) < 10 * len(rows)


@pytest.mark.parametrize("ttls, list_rows", [((0, 1, 60, 90, 600), 1000), ((5, 7, 9, 40_000, 90_000), 1), ((1, 1, 2, 3_000, 4 * 10**9), 1)])
def test_conflicts_of_short_and_long_reservations(spark, monkeypatch, ttls, list_rows):
    monkeypatch.setattr(M, "LIST_ROWS", list_rows, raising=False)
    rnd = random.Random(str(ttls))
    patterns = ["**", "*.md", "src/**", "src/a/*.py", "src/a/x.py", "src/?/x.py", "src/a/**", "src/b/**", "docs/**/*.md", "docs/x.md"]
    rows = [(f"p{i % 2}", i, rnd.choice(["u1", "u2", "u3", None]), rnd.choice([*patterns, None]), rnd.choice([True, False, None]),
             T0 + dt.timedelta(seconds=rnd.randrange(0, 3_000, 5)), rnd.choice(ttls)) for i in range(240)] + [(None, 999, "u9", "**", True, T0, 600)]
    got = sorted(map(tuple, M.reservation_conflicts(spark.createDataFrame(rows, RES)).collect()))
    want, held = [], [(*r, r[5] + dt.timedelta(seconds=r[6])) for r in rows if r[6] > 0 and None not in (r[0], r[2], r[3])]
    for x in held:
        for y in held:
            if (x[0] == y[0] and x[1] < y[1] and x[2] != y[2] and (x[4] or y[4]) and x[5] < y[7] and y[5] < x[7] and overlap(x[3], y[3])):
                want.append((x[0], x[1], y[1], x[2], y[2], max(x[5], y[5]), min(x[7], y[7])))
    assert got == sorted(want) and len(got) > 50


def test_long_reservations_have_slices_of_their_own(spark):
    def widths(ttls):
        rows = spark.createDataFrame([("p", 0, t * 10**6) for t in ttls], "project string, s0 long, s1 long")
        return M._slice_widths(rows).collect()[0]["widths"]
    assert widths([60] * 99 + [3600]) == [120 * 10**6]
    assert widths([60] * 9 + [36_000]) == [120 * 10**6, 36_000 * 10**6]
    assert widths([1] * 10**4 + [10**6]) == [2 * 10**6, 10**12]
