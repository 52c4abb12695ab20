"""Session settings and the checkpoint folder.

Library code never builds its own session: every operator takes the
caller's ``SparkSession`` (or a DataFrame) and only reads settings from it.
``build_session`` exists for tests, the benchmark and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at cluster scale.  Shuffle partitions are sized for
# ~128-256 MB per reducer at the target volume and then coalesced at run
# time by AQE; skewed join partitions are split by AQE as well.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# With it Spark removes the shuffle files of a query as soon as the query has ended, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files; for results that are stored and not recomputed."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def build_session(
    master: str | None = None,
    app_name: str = "campaignlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the benchmark and local runs.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``).  A
    checkpoint folder is set only when the session has none.
    """
    cpus = os.environ.get("BENCH_CPUS", "*")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only
    acceptable when the master is local (tests, benchmark).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
            "that every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="campaignlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
