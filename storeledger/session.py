"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings. AQE turns a shuffled join into a broadcast join only
# once the measured side is small enough, and splits skewed join partitions,
# so no operator needs an unchecked broadcast hint.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "storeledger", cpus: int | str = "*", more: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the local bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **(more or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="storeledger-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getConf().get("spark.checkpoint.dir")
    )
    if not folder and spark.sparkContext.master.split("[")[0] == "local":  # one machine: its own folder is shared
        folder = _own_folder()
    if not folder:
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    return folder.rstrip("/")
