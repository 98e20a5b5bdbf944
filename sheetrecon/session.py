"""SparkSession helpers.

Cluster settings (checkpoint dir, shuffle partitions, AQE) normally come
from the cluster. ``get_session`` only fills in what is unset, so it is safe
to call both in tests and on a configured cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on. They are applied only when the caller
# has not set them already.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
STATIC = ("spark.ui.enabled", "spark.ui.showConsoleProgress")


def get_session(master: str | None = None, app_name: str = "sheetrecon",
                shuffle_partitions: int | None = None,
                local_memory: str = "12g") -> SparkSession:
    """Session with the library's defaults. For a ``local[...]`` master that
    starts a new JVM, the driver heap (which is the whole executor memory in
    local mode) is sized to ``local_memory``; on a cluster nothing is set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local") and SparkSession.getActiveSession() is None:
            builder = builder.config("spark.driver.memory", local_memory)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in DEFAULTS.items():
        if k in STATIC:
            continue  # static, cannot be changed after start
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster checkpoint dir; set a scratch one only when unset
    in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; if it is missing there, this raises instead of pointing executors
    at machine-local folders. Only a ``local[...]`` session (tests) gets a
    fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(e.g. on HDFS or object storage) for checkpoints")
    local = tempfile.mkdtemp(prefix="sheetrecon-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def recommended_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of input on
    ``total_cores`` executor cores (apply at submit time; nothing here
    overrides a running session).

    * scan splits of 256 MB, shuffle partitions sized to about 200 MB each
      (at least 3 per core), AQE coalescing back to 256 MB targets;
    * skew join splitting for partitions 5x the median and above 256 MB;
    * broadcast only below 64 MB (size-checked by the optimizer / AQE).
    """
    mb = 1024 * 1024
    shuffle = max(total_cores * 3, input_bytes // (200 * mb))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mb),
    }
