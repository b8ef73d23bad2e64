"""Spark session and shared-storage helpers.

Everything in the library takes a ``SparkSession`` explicitly; this module only
builds one for tests/bench and resolves where iterative jobs cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC event time, AQE with skew-join and
# partition coalescing (hot projects, small shuffles), Arrow for the few
# pandas paths, and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # delete the files of reliable checkpoints once their frames are garbage
    # (graph loops cut lineage every round)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster profile for fleet-scale inputs (~100 TB): start shuffles wide and let
# AQE coalesce them to ~256 MB partitions (and split skewed ones), read files
# in 512 MB splits, and keep the auto-broadcast limit at a size every executor
# can hold — broadcasts are only ever chosen by this size check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "keelson",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and ``cluster=True`` and let
    spark-submit decide the rest; the cluster's own ``spark.checkpoint.dir``
    is then used by graph jobs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` (the cluster's shared folder) or the
    directory already set on the context. Only a local-mode session with
    neither gets a private temporary folder; a cluster without the setting is
    an error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="keelson-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError(
        "spark.checkpoint.dir is not set; graph jobs need a shared folder to cut lineage")
