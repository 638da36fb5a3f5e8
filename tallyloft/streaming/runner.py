"""Starting and watching the streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tallyloft.functions.scalar import event_time
from tallyloft.streaming import decode, sinks
from tallyloft.streaming.enrich import derive, enrich, with_fresh_stores, with_stores
from tallyloft.streaming.messages import hot_items
from tallyloft.streaming.orders import once, running

Dims = Callable[[], tuple[DataFrame, DataFrame]]


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything there is, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def item_batches(
    raw: DataFrame,
    read_dims: Dims,
    table: sinks.UpsertTable,
    dead_letters: str,
    checkpoint: str,
    run_id: int,
    seen_at: Column | None = None,
    read_body: decode.BodyReader = decode.json_body,
) -> DataStreamWriter:
    """Decode, enrich and upsert each micro-batch; bad messages go aside and the stream goes on.

    The dimensions are read anew for each batch, so a renamed store shows up without a restart.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        decoded = decode.decode(batch, read_body).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sinks.write_dead_letters(decode.rejected(decoded), f"{dead_letters}/run_id={run_id}", batch_id)
            stores, products = read_dims()
            table.write(hot_items(enrich(decode.good(decoded), stores, products, seen_at)), run_id, batch_id)
        finally:
            decoded.unpersist()

    return raw.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def order_events(
    raw: DataFrame, stores: DataFrame, seen_at: Column | None = None, read_body: decode.BodyReader = decode.json_body
) -> DataFrame:
    """What the order aggregate needs: products play no part in it."""
    return derive(with_stores(decode.good(decode.decode(raw, read_body)), stores), seen_at)


def dead_letters(
    raw: DataFrame, path: str, checkpoint: str, read_body: decode.BodyReader = decode.json_body
) -> DataStreamWriter:
    """The messages that ``order_events`` leaves out, with their reasons: a query of its own, as aggregates cannot branch."""
    return sinks.parquet(decode.rejected(decode.decode(raw, read_body)), path, checkpoint)


def fresh_order_events(
    raw: DataFrame, store_changes: DataFrame, seen_at: str | None = None, read_body: decode.BodyReader = decode.json_body, **join
) -> DataFrame:
    """``order_events`` with stores from a stream of changes: a renamed store shows in the orders after the change, without a restart.

    ``seen_at`` names a column of the messages.
    """
    events = decode.good(decode.decode(raw, read_body)).withColumn("event_ts", event_time(F.col("event_timestamp")))
    return derive(with_fresh_stores(events, store_changes, **join), F.col(seen_at) if seen_at else None)


def order_updates(raw: DataFrame, stores: DataFrame, seen_at: Column | None = None, once_within: str | None = None, **kwargs) -> DataFrame:
    """Running totals per order.

    With ``once_within`` a message that is delivered again within that time counts once; events that come later than that after
    newer ones are then left out, as it is no longer known whether they were seen. Without it every delivery counts, however late.
    """
    events = order_events(raw, stores, seen_at, **kwargs)
    if once_within is None:
        return running(events)
    return running(once(events, ["order_serial", "event_type", "event_ts"], once_within), lateness=None)


class Progress(StreamingQueryListener):
    """Keeps the latest progress of each query."""

    def __init__(self):
        self.last: dict[str, object] = {}
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.last[str(event.progress.id)] = event.progress

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.failed[str(event.id)] = event.exception


def supervise(spark: SparkSession, timeout_seconds: int | None = None) -> int:
    """Wait until any query ends; the number of queries still active."""
    spark.streams.awaitAnyTermination(timeout_seconds) if timeout_seconds else spark.streams.awaitAnyTermination()
    return len(spark.streams.active)
