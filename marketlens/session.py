"""SparkSession construction with the settings the analytics rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs: UTC wall clock (timestamps are zone-less),
# adaptive execution for partition coalescing and skewed joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # plan strings are rendered for every adaptive re-plan; bound them so a
    # deep lineage cannot exhaust the driver heap
    "spark.sql.maxPlanStringLength": "1000000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.setdefault("spark.driver.memory", "4g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (e.g. the driver's)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.maxPlanStringLength"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``. Where it is unset, a
    local master gets a fresh scratch folder; on a cluster that is an error, as
    executors would each write to their own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def storage_memory(spark: SparkSession) -> int:
    """Bytes of the executors' memory for cached blocks and tasks together; on a
    cluster without the driver's, which holds no task's blocks."""
    sc = spark.sparkContext
    status = sc._jsc.sc().getExecutorMemoryStatus()
    own = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    found, names = {}, status.keysIterator()
    while names.hasNext():
        name = names.next()
        found[name] = status.apply(name)._1()
    return sum(size for name, size in found.items() if name != own or len(found) == 1)
