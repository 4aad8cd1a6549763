"""Session helpers: settings the jobs rely on, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at run time (broadcast
# when a side turns out small, skew split for hot keys, partition
# coalescing); dynamic partition overwrite lets a snapshot rewrite only the
# days it touched.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Settings for ``joins.reduce_by_keys`` on a cluster.  Spark compares the size
# of the whole scan behind a key list with the threshold, so it has to be above
# that of the largest key source; the filter itself stays within ``maxNumBits``
# (128 MB here, some 100 million keys at 3 % false positives).
REDUCE_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1PB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 30),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(128 << 20),
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(64 << 20),
}
# Results do not depend on the session time zone (all timestamps are
# wall-clock TIMESTAMP_NTZ); local sessions pin UTC only for readable logs.
LOCAL_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "arrears", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the launcher supplies master and
    sizing; only the job settings above are applied there."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**JOB_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    current setting).  Only when neither is set and the master is local --
    a test or a laptop -- a private folder is created and registered; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster job needs a shared checkpoint folder")
        # local runs and tests only: a private folder on this machine
        configured = tempfile.mkdtemp(prefix="arrears-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
