"""Session settings the marts rely on.

* UTC session time zone: every DATETIME column is wall time without zone
  (``timestamp_ntz``), and "now" is UTC wall time.
* ANSI mode on (the default): a division by zero raises instead of returning
  NULL; every division in the marts is guarded.
* AQE on: coalesces small shuffle partitions, splits skewed join partitions,
  and turns sort-merge joins into broadcast joins once a side's measured size
  is under the threshold.
* Broadcast bounds: a side planned from estimates (file sizes) is broadcast
  only under 10 MB; a side whose size AQE has *measured* after its shuffle
  stage may be broadcast up to 64 MB. A measured size is a proven bound, an
  estimate is not; anything larger stays a sort-merge join.
* Dynamic partition overwrite: an incremental merge rewrites only the
  partitions it touches.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that hold for every deployment size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where its partitioning serves a later operator
    # (two joins or a regroup on one key): the extra shuffle is the smaller cost
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Cluster profile: many initial shuffle partitions that AQE coalesces down to
# ~256 MB each, so a 100 TB input does not produce multi-GB tasks that spill.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def build_session(master: str | None = None, app: str = "litreflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the marts' settings.

    ``master=None`` leaves the master to spark-submit (cluster runs) and uses
    the cluster profile; a ``local[...]`` master uses as many shuffle
    partitions as given (default: 2 per core).
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if master is None:
        conf.update(CLUSTER_CONF)
    else:
        builder = builder.master(master)
        conf["spark.driver.memory"] = os.environ.get("LITREFLOW_DRIVER_MEMORY", "16g")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 16)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, conf[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as the deployment sets it
    (a distributed file system path every executor can reach); a cluster
    session without it is an error. Only for a local master (tests, local
    runs) a folder is created and registered when the setting is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - older API surface
            current = None
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            # a machine-local folder is not shared by the executors
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can "
                               "reach (e.g. on the cluster's distributed file system)")
        current = tempfile.mkdtemp(prefix="litreflow-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(current)
        except Exception:  # pragma: no cover - sessions without a SparkContext
            pass
    return current.rstrip("/")


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """A write or an action that begins in here removes its shuffle files when it
    ends. Otherwise they stay until the driver collects its plan as garbage, and
    the writes of one query fill the disk with each other's."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written, on any file system."""
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)
