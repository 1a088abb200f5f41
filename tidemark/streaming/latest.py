"""Newest version per key as a stream: state instead of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# A state store that holds its keys on disk and saves what a micro-batch changed, not its files.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def use_typed_state(spark: SparkSession) -> None:
    """Set the state store for streams that this session starts from now on."""
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)


def newest_versions(stream: DataFrame, key: str, version: str, tie: str) -> DataFrame:
    """Rows of ``stream`` that are newer than all rows of their key before them, one per key and batch.

    The state is the newest row of every key and the time of the micro-batch that brought it; a row
    is sent if that is the running one. A micro-batch that is tried again has the time it had before.
    Equal versions go to the greater ``tie`` and then to the earlier micro-batch, so the rows last
    sent of all keys do not depend on the order of arrival, and after a restart nothing older is sent
    again. Rows without a key, version or tie take no part. To be written in update mode.
    """
    now = F.unix_millis(F.current_timestamp())
    known = stream.where(F.col(key).isNotNull() & F.col(version).isNotNull() & F.col(tie).isNotNull())
    row = F.struct(*[F.col(c) for c in stream.columns if c != key], F.col("_since"))
    rank = F.struct(F.col(version), F.col(tie), -F.col("_since"))
    best = known.withColumn("_since", now).groupBy(key).agg(F.max_by(row, rank).alias("_row"))
    fresh = best.where(F.col("_row._since") == now)
    return fresh.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in stream.columns])
