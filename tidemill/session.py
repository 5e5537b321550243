"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings. Partition counts and broadcast thresholds are left to the cluster.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream: an extra
    # exchange of everything is cheaper than one task holding a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

BUSINESS_ZONE = "Asia/Shanghai"


def tune(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def local_session(cores: int = 8, time_zone: str = "UTC", app: str = "tidemill") -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.tidemill.scan.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.driver.extraJavaOptions", "-Xss4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Without the setting only a session on one machine (tests) gets a folder, the same one for its whole life; a
    cluster must name one, as a folder of one machine would be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemill-")
