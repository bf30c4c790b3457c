"""Event streams: one column ``value`` with the raw message text, whatever the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 **options: str) -> DataFrame:
    """Messages of a topic with their partition and offset.

    Needs the public Kafka connector on the class path. ``latest`` skips what was sent before the
    first start.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of the JSON Lines files arriving in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def event_stream(spark: SparkSession, kind: str, **options) -> DataFrame:
    if kind == "kafka":
        return kafka_stream(spark, **options)
    if kind == "files":
        return file_stream(spark, **options)
    raise ValueError(f"unknown stream kind {kind!r}; choose kafka or files")
