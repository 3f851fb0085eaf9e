"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (sort-merge
# -> broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed ones; the runtime bloom filter prunes the line
# table by the surviving order keys before the order/line shuffle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "salesnet", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` so a partition holds ~128-256 MB of shuffle data
    (AQE coalesces downwards from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("SALESNET_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is configured.

    An existing setting wins (the cluster's shared ``spark.checkpoint.dir`` or a
    folder the user set).  Only a local-mode session (tests) without one gets a
    fresh folder under the system temp directory; a cluster session without one
    is an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running salesnet jobs on a cluster")
    local = tempfile.mkdtemp(prefix="salesnet-ckpt-")
    _LOCAL_ROOTS[id(sc)] = local
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def checkpoint_root(spark: SparkSession) -> str:
    """The checkpoint folder without the per-application subfolder Spark adds, so that
    paths under it (streaming checkpoints) are stable across application restarts."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = ensure_checkpoint_dir(spark)
    return _LOCAL_ROOTS.get(id(sc)) or os.path.dirname(current.rstrip("/"))
