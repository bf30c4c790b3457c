"""Batch writers: the event table, the batch watermark, CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.scalars import iso_utc, utc_date


def write_events(events: DataFrame, path: str, mode: str = "append",
                 records_per_file: int = 5_000_000) -> None:
    """Event table partitioned by day.

    The rebalance hint gathers a day's rows into few files and lets Spark split days that are too
    big for one task.
    """
    (
        events.withColumn("event_date", utc_date(F.col("event_time")))
        .hint("rebalance", "event_date")
        .write.mode(mode).option("maxRecordsPerFile", records_per_file)
        .partitionBy("event_date").parquet(path)
    )


def write_watermark(events: DataFrame, path: str) -> None:
    """Store how far the batch table reaches, as ISO text."""
    newest = events.agg(iso_utc(F.max("event_time")).alias("value"))
    newest.filter(F.col("value").isNotNull()).write.mode("overwrite").text(path)


def export_csv(result: DataFrame, path: str) -> None:
    """CSV with a header line, written by the executors."""
    result.write.mode("overwrite").option("header", True).csv(path)
