"""Session helpers.

Every operator in this package is a pure ``DataFrame -> DataFrame`` function; the
only place that touches cluster configuration is here.  On a real cluster the
session is created by the platform and ``get_session`` simply returns it; the
local defaults below only apply when nothing is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for correct results (not for speed).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for a healthy plan at scale.  AQE re-plans joins (broadcast vs
# sort-merge) from runtime sizes, coalesces small shuffle partitions and splits
# skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakelayer") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKELAYER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is (also when it was only set on the SparkContext).  Only
    where it is unset and the master is local -- tests, the bench -- a scratch
    folder is created; off local mode an unset folder is an error."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="lakelayer-ckpt-")
    if spark.conf.get("spark.checkpoint.dir", None) != current:
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
