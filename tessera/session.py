"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; UTC keeps the run-log
# arithmetic stable across hosts.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings above.

    On a cluster call it without ``master``: the launcher decides. Locally
    (tests, bench) pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    local = bool(master and master.startswith("local"))
    if local:
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if not local:
        # Cluster: start shuffles wide and let AQE coalesce them to ~128 MB
        # partitions, so one setting serves small and 100 TB inputs. Values the
        # cluster already set win.
        for k, v in CLUSTER_DEFAULTS.items():
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local run without it gets a
    fresh scratch folder (other executors could not see one on a cluster)."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d
