"""First appearance of keys in a stream, and the clock by which rows are late."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import list_folders

BATCH = "ingest_batch="
STATE = {
    # keys never expire, so they are kept on disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def first_seen(stream: DataFrame, keys: dict[str, Column], **values: Column) -> DataFrame:
    """Per key, the aggregates ``values`` and ``_is_new``: whether this batch is its first.

    For update mode. The state is a row per key and doesn't expire. It remembers the times of the
    first and of the last batch that held the key: Spark gives all rows of a batch one time, also
    when the batch is repeated. Rows are combined before they are shuffled, so a key that holds
    most of a batch sends a row per map task.
    """
    came = stream.withColumn("_came", F.current_timestamp())
    return came.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        *[v.alias(k) for k, v in values.items()], F.min("_came").alias("_first"), F.max("_came").alias("_last"),
    ).withColumn("_is_new", F.col("_first") == F.col("_last")).drop("_first", "_last")


def _newest(spark: SparkSession, folder: str) -> tuple[dt.datetime | None, int]:
    held = {int(f.rsplit(BATCH, 1)[1]): f for f in list_folders(spark, folder) if BATCH in f}
    for batch in sorted(held, reverse=True):
        found = spark.read.schema("t timestamp").parquet(held[batch]).first()
        if found is not None:
            return found.t, batch
    return None, -1


class Clock:
    """The latest event time of a stream's batches, one small file each beside its checkpoint.

    It is read when a run starts: rows older than ``delay`` before it are late in this run. A batch
    that is repeated writes its file again.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, delay: str):
        self.folder = f"{checkpoint}-clock"
        self.time, _ = _newest(spark, self.folder)
        # before the first run a time that nothing is older than, as state needs the same columns always
        start = F.lit("0001-01-02").cast("timestamp") if self.time is None else F.lit(self.time)
        self.limit = start - F.expr(f"INTERVAL {delay}")

    def is_late(self, event_time: Column) -> Column:
        return F.coalesce(event_time.cast("timestamp") <= self.limit, F.lit(False))

    def advance(self, batch: DataFrame, event_time: str, batch_id: int) -> None:
        t = F.max(F.col(event_time).cast("timestamp"))
        if self.time is not None:
            t = F.greatest(t, F.lit(self.time))
        batch.agg(t.alias("t")).filter("t IS NOT NULL").write.mode("overwrite").parquet(
            f"{self.folder}/{BATCH}{batch_id}")


def run(stream: DataFrame, land: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start the stream over all that is there; its state lies in RocksDB."""
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings it started with
        return (
            stream.writeStream.outputMode("update").foreachBatch(land)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
