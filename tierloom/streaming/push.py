"""Streams into keyed tables: pushed feature events and incremental orders.

A batch that is replayed after a failure changes nothing: the offline history has a folder per stream and batch, which is
written anew, and the keyed tables only take rows newer than those they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tierloom.operators.features import FeatureView
from tierloom.operators.keyed import upsert_newest
from tierloom.operators.windows import latest_per_key
from tierloom.sources.bucketed import BucketedTable


ONLINE, OFFLINE, ONLINE_AND_OFFLINE = "online", "offline", "online_and_offline"


def push_batch(
    events: DataFrame,
    batch_id: int,
    spec: FeatureView,
    offline_path: str,
    latest: BucketedTable,
    to: str = ONLINE_AND_OFFLINE,
    stream: str = "direct",
) -> None:
    """Write one micro-batch to the offline history, the latest table, or both.

    ``stream`` and ``batch_id`` together name the batch; a second push under the same name replaces the first one.
    """
    if to not in (ONLINE, OFFLINE, ONLINE_AND_OFFLINE):
        raise ValueError(f"cannot push to {to}")
    newest = [spec.timestamp_field, spec.created_field]
    rows = spec.apply(events).persist()
    try:
        if to != ONLINE:
            rows.write.mode("overwrite").parquet(f"{offline_path}/stream={stream}/batch_id={batch_id}")
        if to != OFFLINE:
            latest.update(
                latest_per_key(rows, spec.key, newest),
                lambda current, batch: upsert_newest(current, batch, spec.key, newest),
            )
    finally:
        rows.unpersist()


def push_stream(
    events: DataFrame,
    spec: FeatureView,
    offline_path: str,
    latest: BucketedTable,
    checkpoint: str,
    to: str = ONLINE_AND_OFFLINE,
) -> StreamingQuery:
    """Push a stream of feature events to the offline history and the latest table, until the input is used up.

    The newer (time, created) wins in the latest table, so events may arrive out of order.
    """

    def push(df: DataFrame, batch_id: int) -> None:
        # The id lives in the checkpoint: a restarted stream keeps it, a new one counts its batches under its own.
        stream = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        push_batch(df, batch_id, spec, offline_path, latest, to, stream)

    return (
        events.writeStream.foreachBatch(push)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_offline(spark: SparkSession, offline_path: str, spec: FeatureView) -> DataFrame:
    """The offline history, one row per (key, time, created): an event pushed twice counts once."""
    rows = spark.read.parquet(offline_path).drop("stream", "batch_id")
    return rows.dropDuplicates([spec.key, spec.timestamp_field, spec.created_field])


def upsert_stream(
    orders: DataFrame, table: BucketedTable, cursor: str, tie_break: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Incremental load as a stream: each batch keeps the newest row per key and replaces older ones in the table."""
    order_by = [cursor, *tie_break]

    def load(df: DataFrame, batch_id: int) -> None:
        rows = df.persist()
        try:
            table.update(
                latest_per_key(rows, table.key, order_by),
                lambda current, batch: upsert_newest(current, batch, table.key, order_by),
            )
        finally:
            rows.unpersist()

    return (
        orders.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
