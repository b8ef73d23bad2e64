"""Running values per key in an order, without a task per key.

A window over a key puts all rows of the key in one task; one agent or project with a third
of the rows then holds the job up. Here rows are dealt to ranges of (key, order) of about
equal size, each range is one task, and a range's running values are shifted by what the
key's earlier ranges add up to. Only the keys at a range's border are split, so the shifts
are at most two rows a range, whatever the number of keys: a broadcast of proven size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import checkpoint_dir

KINDS = ("sum", "max_before", "last_before", "total")


def cut(df: DataFrame) -> DataFrame:
    """Reliable lineage cut in the session's checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """Reliable lineage cut as a table written to the shared checkpoint folder and read again.

    A written table has the size of its files. A checkpointed frame keeps the optimizer's
    estimate of its plan, in which a join multiplies the sizes of its sides: in a loop the
    estimate's digits multiply from round to round, until planning takes longer than the work
    (measured: 26 s in the seventh round of ``weak_components``). So loops cut their rounds by
    ``cut``, which is cheaper, and settle every few rounds and at their ends. The tables lie
    under ``cuts/<application>``, to be removed with the application's other checkpoints."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cuts/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_round(df: DataFrame, r: int, every: int = 6) -> DataFrame:
    """The cut of round ``r`` of a loop: every few rounds a settled one."""
    return settled(df) if r % every == 0 else cut(df)


def dealt(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``rows`` dealt to ranges of (keys, order), with the range's number as ``_range``: a
    range is one partition, and windows over (``_range``, ...) need no other exchange."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()).repartitionById(n, F.col("_range"))


def running(rows: DataFrame, keys: list[str], order: list, **values: tuple[str, Column]) -> DataFrame:
    """``rows`` with one more column per value, given as name=(kind, column):

    * ``sum``: sum over the key's rows up to and including this one;
    * ``max_before``: greatest value of the key's earlier rows (null for its first);
    * ``last_before``: value of the key's previous row (null for its first);
    * ``total``: sum over all rows of the key.

    ``order`` holds column names or sort expressions and should be a total order within a
    key; null keys are a key; without keys all rows are one.
    """
    bad = [k for k, (kind, _) in values.items() if kind not in KINDS]
    if bad:
        raise ValueError(f"unknown kind of {bad}")
    given = rows.columns
    rows = rows.select("*", *[v.alias(f"_v_{k}") for k, (_, v) in values.items()])
    seen = Window.partitionBy("_range", *keys).orderBy(*order)
    upto = seen.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = seen.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_range", *keys)
    local = [F.lead(F.lit(1)).over(seen).isNull().alias("_last")]
    for k, (kind, _) in values.items():
        v = F.col(f"_v_{k}")
        if kind == "sum":
            local.append(F.sum(v).over(upto).alias(f"_l_{k}"))
        elif kind == "total":
            local.append(F.sum(v).over(whole).alias(f"_l_{k}"))
        elif kind == "max_before":
            local += [F.max(v).over(before).alias(f"_l_{k}"), F.max(v).over(upto).alias(f"_e_{k}")]
        else:
            local += [F.lag(F.struct(v.alias("x"))).over(seen).alias(f"_l_{k}")]
    part = cut(dealt(rows, keys, order).select("*", *local))
    # what a range adds to its key: the values at the key's last row in it
    ends = part.filter("_last").select("_range", *keys, *[
        (F.struct(F.col(f"_v_{k}").alias("x")) if kind == "last_before" else F.col(f"_e_{k}") if kind == "max_before" else F.col(f"_l_{k}")).alias(f"_c_{k}")
        for k, (kind, _) in values.items()])
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = {"sum": lambda c: F.sum(c).over(earlier), "max_before": lambda c: F.max(c).over(earlier),
             "last_before": lambda c: F.last(c, ignorenulls=True).over(earlier), "total": lambda c: F.sum(c).over(of_key)}
    carried = (ends.withColumn("_parts", F.count(F.lit(1)).over(of_key))
               .select("_range", *keys, "_parts", *[shift[kind](F.col(f"_c_{k}")).alias(f"_c_{k}") for k, (kind, _) in values.items()])
               .filter("_parts > 1").drop("_parts"))
    carried = carried.select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], *[f"_c_{k}" for k in values])
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    out = part.join(F.broadcast(carried), same, "left")      # two rows a range at most
    merged = {
        "sum": lambda k: F.when(F.col(f"_c_{k}").isNull(), F.col(f"_l_{k}")).otherwise(F.coalesce(F.col(f"_l_{k}") + F.col(f"_c_{k}"), F.col(f"_c_{k}"))),
        "max_before": lambda k: F.greatest(f"_l_{k}", f"_c_{k}"),
        "last_before": lambda k: F.coalesce(f"_l_{k}", f"_c_{k}")["x"],
        "total": lambda k: F.coalesce(f"_c_{k}", f"_l_{k}")}
    return out.select(*[F.col(f"`{c}`") for c in given], *[merged[kind](k).alias(k) for k, (kind, _) in values.items()])


def ranked(rows: DataFrame, keys: list[str], order: list, name: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) within the key."""
    return running(rows, keys, order, **{name: ("sum", F.lit(1).cast("bigint"))})


def percentiles(counts: DataFrame, keys: list[str], value: str, n: str, at: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear between neighbours) of every key's values, one row per key:
    the keys, ``n`` (their sum) and a column per entry of ``at`` (name: share). ``counts``
    has one row per key and distinct value with its number ``n``. The ranks are found by a
    running count over ranges, so no task holds a key's values."""
    r = running(counts, keys, [value], _upto=("sum", F.col(n)), _all=("total", F.col(n)))
    cols = [F.max("_all").alias(n)]
    for name, share in at.items():
        place = (F.col("_all") - 1) * F.lit(share)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("_upto") > rank) & (F.col("_upto") - F.col(n) <= rank)
            cols.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}_{side}"))
    out = r.groupBy(*keys).agg(*cols)

    def between(name, share):
        place = (F.col(n) - 1) * F.lit(share)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)
    return out.select(*keys, n, *[between(k, s) for k, s in at.items()])
