"""Raw landing of messages and the continuous build of the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.parsing import normalize_v1, position_of
from clickloom.operators.quality import checked_messages, quarantined, valid_messages


def start_landing(messages: DataFrame, path: str, checkpoint: str, records_per_file: int = 1_000_000,
                  trigger: str = "60 seconds", available_now: bool = False) -> StreamingQuery:
    """Keep every message as it came, one JSON line with the field ``value`` each; nothing is filtered, and line
    breaks and nulls survive."""
    writer = (
        messages.select(F.col("value").cast("string").alias("value")).writeStream.format("json")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", records_per_file)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_event_table(messages: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                      repeats: str | None = "1 hour") -> StreamingQuery:
    """Valid messages into the event table, by day. The file sink commits each batch once.

    An event sent again within ``repeats`` of its arrival is left out; None keeps all. The span counts from the arrival,
    so no event is too late for it.
    """
    events = normalize_v1(valid_messages(checked_messages(messages, position_of(messages))))
    if repeats:
        arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", repeats)
        events = arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")
    return _files(events, path, checkpoint, available_now, "event_date")


def start_quarantine(messages: DataFrame, path: str, checkpoint: str,
                     available_now: bool = False) -> StreamingQuery:
    """Messages that broke the contract, with the broken rules."""
    return _files(quarantined(checked_messages(messages)), path, checkpoint, available_now)


def _files(rows: DataFrame, path: str, checkpoint: str, available_now: bool,
           *partition: str) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition:
        writer = writer.partitionBy(*partition)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
