"""Session settings used by the tests and the bench; a cluster brings its own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(name: str = "tidemill", cpus: str | None = None) -> SparkSession:
    """A `local[n]` session with adaptive execution on and the zone pinned to UTC."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settings_for(input_bytes: int) -> dict[str, str]:
    """Session settings for an input of this size: about 128 MB per shuffle partition, which the adaptive planner may
    merge but never splits, larger scan splits, skewed joins split, stream state in RocksDB.
    """
    partitions = max(200, -(-input_bytes // (128 * 1024 * 1024)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a session that names none (a local test) gets a folder of its own. A folder on one machine would be
    lost with that machine, so on anything but a local master a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tidemill-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
