"""Session helpers.

The library never builds its own session inside an operator: callers pass a
``SparkSession`` or DataFrames.  ``local_session`` exists for tests, the bench
and the driver smoke check.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lodestar") -> SparkSession:
    """A local session tuned for small scale factors (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # checkpoints of frames that are garbage-collected are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``checkpoint()`` at the shared folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session without that setting (tests, bench) gets a fresh scratch folder;
    a cluster session without it is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder (HDFS/S3) before running this job")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside leave no shuffle files once they have ended.

    Otherwise the files stay until the driver happens to collect its garbage, so that
    a job of many steps holds what all of them have shuffled.  A query is planned when
    its DataFrame is made: a caller's ``df`` is run as ``df.select("*")``.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once for each application.

    Tasks import the functions that they run; ``addPyFile`` makes that work
    wherever the package is installed on the driver alone.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lodestar-"), "lodestar.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Runtime SQL settings sized for an input of ``input_bytes`` on ``cores`` cores.

    * shuffle partitions: enough for ~``target_partition_bytes`` per partition
      of a shuffle as large as the input, at least 2x the cores (AQE merges
      small ones back to the advisory size at run time);
    * file splits of 256 MB (long article texts expand several-fold when
      tokenised, so splits stay well below executor memory);
    * AQE with skew-join splitting: a partition 5x the median and over 512 MB
      is split on the large side.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, cores: int | None = None) -> dict:
    """Set :func:`scale_conf` on a running session (all are runtime SQL settings)."""
    conf = scale_conf(input_bytes, cores or spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
