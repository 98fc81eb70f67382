"""Session construction and the shared scratch location.

Everything that must outlive a task (checkpoints, staged members, published
versions) goes under ``spark.checkpoint.dir`` as the cluster names it; only a
local master (tests) may go without.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cadastre", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for a while."""
    own = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in own.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: A query's shuffle files go when it has ended; else they stay until the driver happens to
#: collect its garbage, and the disk holds those of all queries since.  A lost one is made again.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged data:
    ``spark.checkpoint.dir`` of the session.  Only a local master may go without
    it (tests) and then gets a folder of its own; on a cluster a folder of one
    machine would be wrong, so that is an error."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="cadastre-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    if sc.master.startswith("local") and path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/cadastre/{label}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


MAX_SHUFFLE_PARTITIONS = 100_000


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int) -> dict[str, str]:
    """Starting configuration for a large cluster, derived from the size of the
    largest table one job shuffles (``input_bytes``).

    * shuffle partitions: enough that each holds ~256 MB of that table and at
      least 3 waves of the cluster's cores (capped so shuffle metadata on the
      driver stays bounded); AQE then coalesces the small ones and splits
      skewed ones (a key holding a third of a table);
    * file splits of 256 MB for the parquet and CSV scans;
    * broadcast threshold kept at a size an executor can hold many times over.
    """
    cores = max(1, executors * cores_per_executor)
    by_size = int(input_bytes // (256 * 1024 * 1024)) + 1
    partitions = min(max(cores * 3, by_size), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
