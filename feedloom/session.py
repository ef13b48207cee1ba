"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Set at run time on whatever session is handed in. Sizes and partition counts
# are left to the cluster: these only switch behaviour.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files are compressed; what they hold in memory, and so what is broadcast, is a multiple.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Split a hot partition even if a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on and return the session.

    They hold for all that uses this session afterwards.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


#: Stands in for the shared folder in local sessions; sessions of one process share it.
_local_base: str | None = None


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, one per call.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, so
    that every executor sees it and a lost executor loses nothing. Only where that
    is unset, as in tests, a machine-local folder stands in.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="feedloom-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
