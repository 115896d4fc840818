"""Session settings the jobs are written for."""

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Unsorted hash joins where every shuffle partition is small; decided at run time.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def local_session(app: str, cores: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benchmarks, within one process. A cluster brings its own; see ``SETTINGS``."""
    for name in ("spark.checkpoint.dir", "spark.sql.warehouse.dir"):
        extra.setdefault(name, tempfile.mkdtemp(prefix="claimledger-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
