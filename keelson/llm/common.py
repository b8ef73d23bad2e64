"""Shared helpers of the training-data operators: table reading, reliable
lineage cuts, bounded Arrow slices and connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import checkpoint_dir

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the cluster's shared checkpoint folder (survives the loss
    of executors, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """The shared folder for tables a job writes and reads again."""
    return checkpoint_dir(spark).rstrip("/")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """Cut a batch so that the texts of a slice take about ``limit`` bytes at
    most (one text is never cut), which bounds a task's working memory."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = batch.column(column).cast(pa.large_binary())
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i in range(n):
        if i > start and held + lengths[i] > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(lengths[i])
    yield batch.slice(start)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns one row (node, root) per node that has an edge; ``root`` is the
    least node of its component. A round is a partial aggregation (least
    neighbour per node) and an equi-join, cut by a reliable checkpoint; the loop
    ends when all edges are stars around their roots. Only a count reaches the
    driver. Self loops and repeated edges are harmless; null ends are dropped.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        # large star: every larger neighbour of u points at u's least neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: u and its smaller neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # done when all edges are stars: one edge per u, and no v is a u
        marks = e.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            e.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        open_ = marks.groupBy("u").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where("out > 1 or (out > 0 and into > 0)")
        if open_.agg(F.count("*")).first()[0] == 0:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
