"""Every registered job against its DuckDB oracle at sf0.001 (row count,
column names and an order-insensitive value hash), and every stream against
its batch twin."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from keelson.plans.registry import JOBS
from keelson.sources.bind import RAW_TABLES
from keelson.streaming import jobs as S

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in RAW_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_job_has_an_oracle():
    assert set(JOBS) <= set(oracle_sql()) and set(JOBS) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["project", "task_id"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(S.JOBS))
def test_stream_equals_batch_twin(spark, name):
    a = S.JOBS[name](spark, SF)
    b = S.BATCH_TWINS[name](spark, SF).select(*a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
