"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE gives runtime broadcast conversion (a
# size-checked broadcast), partition coalescing and skew-join splitting of hot
# keys; UTC keeps dates identical to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tidemark",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder used for reliable checkpoints and materialised tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    wins.  Only a ``local`` master without the setting (tests, benchmarks) gets
    a fresh private folder, because there the machine is the whole cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        base = os.environ.get("TMPDIR", "/tmp")
        folder = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=base)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: name a shared (distributed) folder "
        "so that materialised intermediates survive the loss of an executor"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for a written table."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex}"


# Open scratch scopes per driver thread (innermost last); materialise()
# records the tables it writes in the innermost one.
_LOCAL = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def materialise_at(df, name: str = "table", keep: bool = False):
    """``materialise`` that also returns the written folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    scopes = _scopes()
    if scopes and not keep:
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise(df, name: str = "table", keep: bool = False):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: later passes read the written table instead of recomputing the
    lineage, the data survives the loss of an executor, and the planner sees
    its real size.  One job.  Inside a ``scratch_scope`` the table is deleted
    when the scope ends unless ``keep``."""
    return materialise_at(df, name, keep)[0]


def delete_path(spark, path: str) -> None:
    """Recursive delete through the Hadoop FileSystem of the path (works for
    local, HDFS and object-store folders alike)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark):
    """Delete the intermediate tables written inside the block when it ends.
    Use it only around work whose results were written with ``keep=True``
    (or elsewhere) before the block closes."""
    made: list[str] = []
    _scopes().append(made)
    try:
        yield made
    finally:
        _scopes().pop()
        for path in made:
            delete_path(spark, path)


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Shuffles start with enough partitions for ~``target_partition_bytes``
    each (so a task's shuffle block fits executor memory and spills little),
    at least two waves of the cluster's cores; AQE then coalesces small ones
    and splits skewed ones.  Scans read splits of the same size."""
    cores = executors * cores_per_executor
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # runtime broadcast only of sides measured below this size
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
