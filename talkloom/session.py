"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions and splits skewed join
# partitions; the operators place an exchange after every join on a key that
# may be hot, so that the split applies.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: str = "8",
    partitions: int = 8,
    memory: str = "8g",
    scratch: str = "/tmp/checkpoints/talkloom",
) -> SparkSession:
    """A local session for tests and benchmarks; ``scratch`` is where stored tables go."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("talkloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
