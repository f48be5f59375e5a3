"""Starting streams: state store, triggers, append sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterlake.session import ROCKSDB_STATE

STATE_STORE = "spark.sql.streaming.stateStore"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Weeks of event ids do not fit on the heap; RocksDB holds them off it. Batches
    checkpoint only what changed. The durable copy is in the checkpoint folder, so
    lost executors cost nothing.
    """
    spark.conf.set(f"{STATE_STORE}.providerClass", ROCKSDB_STATE)
    spark.conf.set(f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled", "true")


def append_to(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet directory.

    Without `every` the query takes in what is there, in several batches, and stops;
    with it (say "2 minutes") it keeps running at that interval. The sink's log and
    the checkpoint belong together: start over by moving to fresh paths for both.
    """
    keep_state_on_disk(df.sparkSession)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded runs; a failed one raises here."""
    for query in queries:
        query.awaitTermination()
