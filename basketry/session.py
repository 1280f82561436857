"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to apply to a session somebody else created.
#  - UTC: calendar days and months are UTC days and months.
#  - skewJoin + forceOptimizeSkewedJoin: a hot join key (one product, one user,
#    or all the NULL users) is split over many tasks even when the aggregation
#    above the join could have reused the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Tasks stay small whatever the size of the data, so that their sorts and hash tables fit in memory. Shuffles begin
# with many partitions, which adaptive execution merges again; a session that names its own sizes keeps them.
INITIAL_PARTITIONS = 512
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.files.openCostInBytes": "1MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    asked = [spark.conf.get(_INITIAL, None) or 0, spark.conf.get("spark.sql.shuffle.partitions")]
    spark.conf.set(_INITIAL, max(INITIAL_PARTITIONS, *map(int, asked)))
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "basketry") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
