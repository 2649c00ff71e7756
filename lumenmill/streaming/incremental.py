"""Incremental curation: new files of a folder go through a stage once and are appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_stage(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    """Processes what is new and ends; every row of the source is in the sink once, whichever batch is run again.

    ``key`` is a column of the source: of rows with equal keys only the first that comes is passed on (nulls are one key; within a batch any of them).
    The keys that have come are state of the query, kept by key in the checkpoint (RocksDB unless the session names another store), so a batch reads no earlier
    output: what it costs doesn't grow with what the sink holds. A batch that is run again finds the state as it was before it, and replaces
    its own folder ``batch=<number>``. An empty batch, as a stage that drops all leaves it, is an empty folder."""

    def put(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").json(f"{sink}/batch={number}")

    if key and spark.conf.get(STORE, None) in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(STORE, ROCKS)
    stream = spark.readStream.schema(schema).json(source)
    if key:
        stream = stream.dropDuplicates([key])
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
