"""All registered jobs and oracles, merged from the job modules.

Registered outputs are plain scalars: array columns are joined with newlines
and DATE columns written as ISO text (operators themselves keep arrays and
dates), so a result compares the same whatever client reads it.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.plans import (context_oracle, coord_jobs, coord_oracle, graph_jobs, graph_oracle, ingest_jobs,
                           ingest_oracle, stream_oracle, work_jobs, work_oracle)
from keelson.streaming import jobs as stream_jobs

_JOBS: dict = {}
ORACLES: dict = {}

for _mod in (graph_jobs, work_jobs, coord_jobs, ingest_jobs, stream_jobs):
    _JOBS.update(_mod.JOBS)
for _mod in (graph_oracle, work_oracle, coord_oracle, ingest_oracle, stream_oracle, context_oracle):
    ORACLES.update(_mod.ORACLES)


def scalar_output(df):
    """Arrays -> newline-joined text, dates -> 'yyyy-MM-dd' (schema-only, no job runs)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "\n")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _wrap(fn):
    def job(spark, sf_dir, **options):
        return scalar_output(fn(spark, sf_dir, **options))
    job.__name__ = getattr(fn, "__name__", "job")
    job.__doc__ = fn.__doc__
    return job


JOBS = {k: _wrap(v) for k, v in _JOBS.items()}

# the same conversion on the oracle side, for the columns that are lists / dates there
_ORACLE_LISTS = {
    "graph_tree": ["parents"], "worktree_summary": ["pending_items"], "pr_issues": ["issues"],
    "normalize_tasks": ["dependencies"], "scanned_tasks": ["dependencies"], "written_tasks": ["dependencies"], "context_resume": ["pending_items"], "context_prfix": ["issues"],
}
_ORACLE_DATES = {"update_log": ["date"]}

for _k, _cols in _ORACLE_LISTS.items():
    _rep = ", ".join(f"array_to_string({c}, chr(10)) AS {c}" for c in _cols)
    ORACLES[_k] = f"SELECT * REPLACE ({_rep}) FROM ({ORACLES[_k]})"
for _k, _cols in _ORACLE_DATES.items():
    _rep = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in _cols)
    ORACLES[_k] = f"SELECT * REPLACE ({_rep}) FROM ({ORACLES[_k]})"
