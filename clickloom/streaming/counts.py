"""Running counts per product and event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.parsing import speed_events, with_product
from clickloom.sinks.snapshots import upsert_counts


def product_event_counts(events: DataFrame) -> DataFrame:
    """Events per product and name; a running count on a stream, a plain one on a table."""
    return with_product(events).groupBy("product_id", "event_name").count()


def start_counts(messages: DataFrame, snapshot_path: str, checkpoint: str,
                 available_now: bool = False, trigger: str | None = None,
                 compact_every: int | None = None) -> StreamingQuery:
    """Count a message stream into a snapshot folder, emitting only the keys that changed."""
    writer = (
        product_event_counts(speed_events(messages)).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert_counts(snapshot_path, compact_every=compact_every))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def windowed_counts(events: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Counts per time window, product and event; rows later than the watermark are dropped.

    ``events`` carries ``event_time_ts``, as ``speed_events`` gives it.
    """
    rows = with_product(events)
    if rows.isStreaming:
        rows = rows.withWatermark("event_time_ts", late)
    return (
        rows.groupBy(F.window("event_time_ts", width), "product_id", "event_name")
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("window_start"), "product_id", "event_name", "count")
    )


def start_windowed_counts(messages: DataFrame, path: str, checkpoint: str, width: str = "1 minute",
                          late: str = "10 minutes", available_now: bool = False) -> StreamingQuery:
    """Closed windows as Parquet files."""
    writer = (
        windowed_counts(speed_events(messages), width, late).writeStream.outputMode("append")
        .format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def exact_counts(batch_events: DataFrame, windows: DataFrame, watermark: DataFrame,
                 width: str = "1 minute", late: DataFrame | None = None) -> DataFrame:
    """Event counts with nothing counted twice: the event table before the batch watermark, the
    windows from it on. A watermark inside a window (of ``width``, as the windows were made) is taken back to the
    window's start on both sides; without one all is taken from the windows. Rows that came too late for their
    window are in the event table, but not in the windows: those after the watermark are missing here, unless ``late``
    (``streaming.late.read_late``) brings their counts."""
    newest = watermark.agg(F.max("watermark").alias("watermark"))
    upto = newest.select(F.window("watermark", width)["start"]).scalar()
    batch = with_product(batch_events).filter(F.col("event_time") < upto)
    batch = batch.groupBy("event_name").agg(F.count("*").alias("count"))
    if late is not None:
        columns = ["window_start", "event_name", "count"]
        windows = windows.select(*columns).unionByName(late.select(*columns))
    speed = windows.filter(F.col("window_start") >= F.coalesce(upto, F.col("window_start")))
    speed = speed.select("event_name", "count")
    return batch.unionByName(speed).groupBy("event_name").agg(F.sum("count").alias("count"))
