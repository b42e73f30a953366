"""Session factory and the runtime settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. UTC is a correctness setting:
# dates are derived from event times. Streaming state lies on local disk, with a log of changes
# in the checkpoint, so a batch uploads what it changed. The rest lets Spark re-plan joins on
# real sizes, merge small shuffle partitions and split skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",    # runs that stop are counted by them
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session for one job. Master, memory and shuffle width come from the cluster or `conf`."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return apply_runtime_conf(builder.getOrCreate())
