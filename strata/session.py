"""Session construction and the few session settings the jobs rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job assumes: timestamps are UTC, ANSI casts raise on bad data,
# AQE re-plans joins/partition counts from runtime sizes and splits skewed
# shuffle partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An overwrite replaces the table; a refresh of single partitions asks for
    # dynamic mode on its own write.
    "spark.sql.sources.partitionOverwriteMode": "static",
    # AQE merges shuffle partitions smaller than this.  The 1 MB default folds a
    # small rebalanced write (hundreds of partition directories) into one task
    # that writes every directory in turn; a lower floor keeps such writes
    # spread over the cores.  Large shuffles never reach this size, so it only
    # affects small ones.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


_SCRATCH: list[str] = []
_TABLES: list[str] = []


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    """A session for tests, the bench and local runs (UI off, UTC, AQE)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    # A listing of many directories is one job for each folder that has more than 32
    # of them, with a task for every directory in it (up to 10,000): a layout by
    # (year, artist_id) cost 3,545 tasks to list.  One task a core lists as well.
    for k, v in {**SESSION_CONF, LISTING: str(spark.sparkContext.defaultParallelism)}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared checkpoint folder.  Only a local master may go without: its one
    machine is driver and executor, so a temporary folder serves."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``; only when
    that is unset (tests, local runs) do we pick one ourselves.  Never a
    machine-local temp dir on a cluster.
    """
    base = checkpoint_base(spark)
    _SCRATCH.append(f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def scratch_table(spark: SparkSession, purpose: str) -> str:
    """A fresh catalog table name, dropped with the scratch directories."""
    _TABLES.append(f"{purpose}_{uuid.uuid4().hex[:8]}")
    return _TABLES[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Drop the tables and delete the directories handed out so far; results that
    still read them must have been consumed.  Returns the directories deleted."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    done = 0
    while _SCRATCH:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done
