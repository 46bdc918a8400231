"""Session settings the operators rely on."""

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing"


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time options that decide results; leave sizing to the cluster's own settings."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A batch writes what it changed in state rather than whole state files.
    spark.conf.set(f"{CHANGELOG}.enabled", "true")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark
