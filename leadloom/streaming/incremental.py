"""Captures as a stream: harvested once, merged idempotently."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.components import ready_to_checkpoint


def dedupe_captures(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drops a capture whose key and content came before within the delay; state older than that goes. Exact whatever the
    delay only together with writes.append_versions in the merge."""
    rows = stream.withColumn("sha", F.sha2(F.col("content").cast("binary"), 256)).withWatermark("fetched_at", delay)
    return rows.dropDuplicatesWithinWatermark(["key", "sha"])


class FirstOfContent(StatefulProcessor):
    """Passes the first capture of a key's content on and remembers it, for a time to live or for ever."""

    def __init__(self, columns: list[str], ttl_ms: int | None):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "fetched_at timestamp", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if self.seen.exists():
            for _ in rows:
                pass
            return
        first = min(rows, key=lambda r: (r["fetched_at"] is None, r["fetched_at"] or 0))
        self.seen.update((first["fetched_at"],))
        yield Row(**{c: first[c] for c in self.columns})

    def close(self) -> None:
        pass


def dedupe_captures_exactly(stream: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Drops every capture whose key and content came before, however late it is: what was seen is state of its own, not
    bound to a watermark. Of one batch the earliest by fetched_at passes. ttl_ms: after how long (by the clock) a content
    may pass again; without it, never, and state grows with the different contents (a row with a hash each, in RocksDB
    on the executors and in the checkpoint). Needs the session to keep state in RocksDB (see with_rocksdb)."""
    rows = stream.withColumn("sha", F.sha2(F.col("content").cast("binary"), 256))
    processor = FirstOfContent(rows.columns, ttl_ms)
    return rows.groupBy("key", "sha").transformWithState(processor, rows.schema, outputMode="Append", timeMode="None" if ttl_ms is None else "ProcessingTime")


def with_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def incremental_harvest(stream: DataFrame, harvest: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Harvests each micro-batch of new captures and hands the rows to merge(rows, batch_id), which has to be idempotent:
    a batch that failed comes again under the same id."""

    def batch(rows: DataFrame, number: int) -> None:
        merge(harvest(rows), number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def replayed(spark: SparkSession, path: str, schema: StructType, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that a streaming job makes of what a folder or file of Parquet holds now; they, and the job's state, lie in the
    shared checkpoint folder. State is kept in RocksDB while the job runs."""
    ready_to_checkpoint(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    with_rocksdb(spark)
    try:
        made = job(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"))  # a pattern: the path may be a file
        made.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(made.schema).parquet(f"{base}/out")
