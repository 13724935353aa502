"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are ordinary runtime settings; none depends on the size of the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a shuffle partition that one hot key has blown up. The force flag keeps the split even
    # when a later aggregate then needs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Streaming state of many keys lives outside the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


SHUFFLE_PARTITION_BYTES = 256 * 1024**2


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, for a batch job roughly that of
    the columns it reads. Shuffles then start with partitions of about 256 MB, whatever
    ``spark.sql.shuffle.partitions`` says; adaptive execution merges them again where less arrives.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark
