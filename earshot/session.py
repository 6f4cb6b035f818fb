"""Session settings: a local session for tests and the bench, and cluster sizing."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MIB = 1 << 20

# Settings every run wants, whatever its size.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The parsed tables are partitioned by a handful of values, so each task can
    # keep one file open per value instead of sorting its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Checkpoint files go when the table they cut the lineage of is no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle sizes for an input of ``input_bytes`` on ``cores`` cores.

    Scan splits grow from 128 MiB to 1 GiB so that a 100 TB input is about
    100,000 tasks; shuffle partitions aim at 256 MiB, with at least two per core
    and at most 60,000 (map outputs times partitions is what the driver tracks).
    AQE merges the small ones.
    """
    split = min(max(128 * MIB, math.ceil(input_bytes / 100_000)), 1024 * MIB)
    partitions = min(max(2 * cores, math.ceil(input_bytes / (256 * MIB))), 60_000)
    return {
        **COMMON,
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def local_session(cpus: int, app_name: str = "earshot", memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for name, value in COMMON.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
