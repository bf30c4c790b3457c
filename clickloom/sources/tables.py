"""Batch sources: event files, the event table, free SQL over it, the batch watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.scalars import parse_iso
from clickloom.schemas import EVENT_TABLE


def event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of JSON Lines files, one column ``value``."""
    return spark.read.text(path)


def landed_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages as the raw landing keeps them, one column ``value``."""
    return spark.read.schema("value STRING").json(path)


def event_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_events(events: DataFrame, name: str = EVENT_TABLE) -> None:
    """Make the event table visible to SQL under its usual name."""
    events.createOrReplaceTempView(name)


def event_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Free SQL over registered tables; values go in as ``:name`` parameters."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def batch_watermark(spark: SparkSession, path: str) -> DataFrame:
    """One row ``watermark``; null when the stored text is not a time."""
    return spark.read.text(path).select(parse_iso(F.col("value")).alias("watermark"))
