"""Upkeep of an event table that a stream keeps writing to: few, ordered files, swapped under its readers.

Layout below ``path``: ``arrivals/batch_id=N/event_date=D`` as the stream writes it, ``days/event_date=D/version=V`` after
compaction, and ``live/version=V``, the list of live folders: one row per day with the version that holds it. Version V
holds all arrivals up to batch V, so readers take the newest finished list and the arrivals after it, and see each
row once whatever is being rewritten. A compaction rewrites only days that arrivals touched.

Inside a day, rows are ordered along a space-filling curve over time, product and event: their places in time, in a bounded
list of product bounds and in the funnel are interleaved bit by bit, so that a filter on any of them skips most row groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.files import delete, numbered_folders, size_of
from clickloom.functions.scalars import utc_date
from clickloom.schemas import FUNNEL_STAGES
from clickloom.session import cleared, settle
from clickloom.sources.snapshots import newest_finished

#: Bits of a day's time and of the products; products that the bounds are picked from.
BITS = 6
SAMPLED_PRODUCTS = 4096
#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Bytes of a file, about.
FILE_BYTES = 256 << 20


def arriving(path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback: a batch's events by day, in a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if "event_date" in batch.columns else batch.withColumn("event_date", utc_date(F.col("event_time")))
        rows.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(
            f"{path}/arrivals/batch_id={batch_id}")

    return write


def start_kept_events(events: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                      trigger: str | None = None) -> StreamingQuery:
    """Events of a stream into a table that ``compact_days`` may put in order at any time."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(arriving(path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def live_days(spark: SparkSession, path: str, version: int | None) -> dict[str, int]:
    """The version that holds each day; one entry per day of the table."""
    if version is None:
        return {}
    rows = spark.read.schema("day STRING, version BIGINT").parquet(f"{path}/live/version={version}").collect()
    return {r["day"]: r["version"] for r in rows}


def _finished(spark: SparkSession, path: str) -> int | None:
    return newest_finished(spark, f"{path}/live", key="version")


def _arrivals(spark: SparkSession, path: str, after: int, upto: int | None = None) -> list[str]:
    found = numbered_folders(spark, f"{path}/arrivals", "batch_id")
    return [f for n, f in sorted(found.items()) if n > after and (upto is None or n <= upto)]


def kept_events(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The table's rows as of now: the days of the newest list (or of the one named) and the arrivals after it.

    ``schema`` has the table's columns, with ``event_date``.
    """
    version = _finished(spark, path) if version is None else version
    days = [f"{path}/days/event_date={d}/version={v}" for d, v in live_days(spark, path, version).items()]
    rows = spark.createDataFrame([], schema)
    names = rows.columns
    if days:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", f"{path}/days").parquet(*days).select(*names))
    fresh = _arrivals(spark, path, -1 if version is None else version)
    if fresh:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", f"{path}/arrivals").parquet(*fresh).select(*names))
    return rows


def product_bounds(events: DataFrame, parts: int = 1 << BITS, most: int = SAMPLED_PRODUCTS) -> list[str]:
    """Products that cut the table into about equal parts, from the products of the least hashes and their rows."""
    seen = events.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((r["product_id"], r["n"]) for r in seen.orderBy(F.xxhash64("product_id")).limit(most).collect())
    total, bounds, so_far = sum(n for _, n in rows), [], 0
    for product, n in rows:
        if so_far * parts // total != (so_far + n) * parts // total and so_far + n < total:
            bounds.append(product)
        so_far += n
    return bounds


def curve(bounds: list[str]) -> Column:
    """A row's place on the curve: bits of time and product in turn, then the event."""
    time = F.floor(F.pmod(F.unix_seconds("event_time"), F.lit(86_400)) * F.lit(1 << BITS) / F.lit(86_400)).cast("long")
    product = F.lit(0).cast("long")
    # Halving the bounds takes as many comparisons as there are bits.
    low, span = F.lit(0), 1 << (len(bounds).bit_length() if bounds else 0)
    listed = F.array(*[F.lit(b) for b in bounds]) if bounds else None
    while bounds and span > 1:
        span //= 2
        passed = F.coalesce(F.get(listed, (low + (span - 1)).cast("int")) < F.col("product_id"), F.lit(False))
        low = low + F.when(passed, span).otherwise(0)
        product = low.cast("long")
    event = F.lit(len(FUNNEL_STAGES))
    for i, stage in reversed(list(enumerate(FUNNEL_STAGES))):
        event = F.when(F.col("event_name") == stage, i).otherwise(event)
    place = F.lit(0).cast("long")
    for bit in range(BITS):
        for n, dimension in enumerate((time, product)):
            place = place + F.shiftleft(F.shiftright(dimension, bit).bitwiseAND(1), 2 * bit + n)
    return F.coalesce(place, F.lit(0)) * (len(FUNNEL_STAGES) + 1) + event


def compact_days(spark: SparkSession, path: str, schema: str, file_bytes: int = FILE_BYTES) -> int | None:
    """Rewrites the days that arrivals have touched since the last time and publishes a new list. Returns its version.

    Arrivals may go on meanwhile; those of batches after the newest finished one are left for the next time.
    ``drop_replaced`` deletes what no reader needs any more.
    """
    before = _finished(spark, path)
    upto = newest_finished(spark, f"{path}/arrivals")
    if upto is None or upto == before:
        return before
    arrived = _arrivals(spark, path, -1 if before is None else before, upto)
    fresh = spark.read.schema(schema).option("basePath", f"{path}/arrivals").parquet(*arrived)
    held = live_days(spark, path, before)
    day = F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY))
    touched = sorted(r[0] for r in fresh.select(day).distinct().collect())  # a row a day
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    old = [f"{path}/days/event_date={d}/version={held[d]}" for d in touched if d in held]
    read, rows = [*arrived, *old], fresh.select(*names)
    if old:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", f"{path}/days").parquet(*old).select(*names))
    with cleared(spark):
        placed = rows.withColumn("_place", curve(product_bounds(rows)))
        parts = max(1, -(-sum(size_of(spark, f) for f in read) // file_bytes))
        ranged = placed.withColumn("version", F.lit(upto)).repartitionByRange(
            parts, "event_date", "_place", "event_time", "product_id").sortWithinPartitions("event_date", "_place", "event_time")
        # Other versions of a day stay where they are: only folders of this version are written.
        ranged.drop("_place").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_date", "version").parquet(f"{path}/days")
        held.update(dict.fromkeys(touched, upto))
        listed = settle(spark.createDataFrame(sorted(held.items()), "day string, version bigint"), "live")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/live/version={upto}")
    return upto


def drop_replaced(spark: SparkSession, path: str) -> None:
    """Deletes arrivals, day versions and lists that the newest list replaces, once no earlier reader is running."""
    newest = _finished(spark, path)
    if newest is None:
        return
    held = live_days(spark, path, newest)
    for n, folder in numbered_folders(spark, f"{path}/arrivals", "batch_id").items():
        if n <= newest:
            delete(spark, folder)
    for day, version in held.items():
        for n, folder in numbered_folders(spark, f"{path}/days/event_date={day}", "version").items():
            if n != version:
                delete(spark, folder)
    for n, folder in numbered_folders(spark, f"{path}/live", "version").items():
        if n < newest:
            delete(spark, folder)
