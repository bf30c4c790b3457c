"""Windowed counts that lose no late row: what comes after its window is closed is counted beside it.

Each micro-batch adds its own counts per window, product and event in ``deltas/batch_id=N``; counts of a window are sums
over batches, so no state is kept and writing a batch again changes nothing. The watermark of a batch is the newest event time
of all batches before it, less ``late``. Rows whose window ended by then are marked late: ``read_windows`` has those in
time, ``read_late`` the others, and together they have every row. (Spark's own windows go by the watermark of the batch
before, so they still take some of these rows; the rest they drop, see ``dropped_rows``.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.files import delete, exists, numbered_folders
from clickloom.operators.parsing import speed_events, with_product
from clickloom.session import cleared, settle
from clickloom.sources.snapshots import newest_finished

KEYS = ["window_start", "window_end", "product_id", "event_name", "late"]
#: ``newest`` is the newest event time among the rows counted, ``behind`` the seconds by which the latest missed the watermark.
COUNTS = ("window_start TIMESTAMP, window_end TIMESTAMP, product_id STRING, event_name STRING, late BOOLEAN, "
          "count BIGINT, newest TIMESTAMP, behind BIGINT")


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("count").alias("count"), F.max("newest").alias("newest"), F.max("behind").alias("behind"))


def read_deltas(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Counts of the newest base and of the batches after it; of those before a batch, if named."""
    base = newest_finished(spark, f"{path}/base", before)
    rows = spark.createDataFrame([], f"{COUNTS}, batch_id BIGINT")
    if exists(spark, f"{path}/deltas"):
        rows = spark.read.schema(f"{COUNTS}, batch_id BIGINT").parquet(f"{path}/deltas").filter(
            (F.col("batch_id") > (-1 if base is None else base)) & (F.lit(True) if before is None else F.col("batch_id") < before))
    rows = rows.drop("batch_id")
    return rows if base is None else rows.unionByName(spark.read.schema(COUNTS).parquet(f"{path}/base/batch_id={base}"))


def watermark(deltas: DataFrame, late: str) -> Column:
    """The newest event time counted, less ``late``; null before the first event."""
    return deltas.agg((F.max("newest") - F.expr(f"INTERVAL {late}")).alias("watermark")).scalar()


def counted_batches(path: str, width: str = "1 minute", late: str = "10 minutes",
                    compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback over events with ``event_time_ts``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(n > batch_id for n in numbered_folders(spark, f"{path}/deltas", "batch_id")):
            raise ValueError(f"{path} holds batches after {batch_id}; a new checkpoint needs a new folder")
        with cleared(spark):
            passed = watermark(settle(read_deltas(spark, path, batch_id).agg(F.max("newest").alias("newest")), "newest"), late)
            rows = with_product(batch).withColumn("_w", F.window("event_time_ts", width))
            is_late = F.coalesce(F.col("_w.end") <= passed, F.lit(False))
            behind = F.when(is_late, F.unix_seconds(passed) - F.unix_seconds("event_time_ts"))
            counts = rows.select(
                F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "product_id", "event_name",
                is_late.alias("late"), F.lit(1).cast("bigint").alias("count"), F.col("event_time_ts").alias("newest"),
                behind.alias("behind"))
            _merged(counts).write.mode("overwrite").parquet(f"{path}/deltas/batch_id={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            _compact(spark, path, batch_id)

    return write


def _compact(spark: SparkSession, path: str, batch_id: int) -> None:
    """One row per window, product and event as of the batch; what the base before covers is deleted."""
    earlier = newest_finished(spark, f"{path}/base", batch_id)
    _merged(read_deltas(spark, path, batch_id + 1)).write.mode("overwrite").parquet(f"{path}/base/batch_id={batch_id}")
    if earlier is None:
        return
    for name, last in (("deltas", earlier), ("base", earlier - 1)):
        for n, folder in numbered_folders(spark, f"{path}/{name}", "batch_id").items():
            if n <= last:
                delete(spark, folder)


def read_windows(spark: SparkSession, path: str, closed_after: str | None = None) -> DataFrame:
    """Counts of the rows that came in time; with ``closed_after`` only of windows that ended so long before the newest event."""
    deltas = read_deltas(spark, path)
    rows = deltas.filter(~F.col("late"))
    if closed_after is not None:
        rows = rows.filter(F.col("window_end") <= watermark(deltas, closed_after))
    return rows.groupBy("window_start", "product_id", "event_name").agg(F.sum("count").alias("count"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Counts of the rows that came after their window was closed, and how many seconds behind the watermark the last of them were."""
    return read_deltas(spark, path).filter("late").groupBy("window_start", "product_id", "event_name").agg(
        F.sum("count").alias("count"), F.max("behind").alias("behind"))


def start_counted_windows(messages: DataFrame, path: str, checkpoint: str, width: str = "1 minute", late: str = "10 minutes",
                          available_now: bool = False, trigger: str | None = None, compact_every: int = 100) -> StreamingQuery:
    """Counts per window of a message stream, late rows apart. The query's progress shows how many rows each batch had
    and its newest event time, as observed metrics named ``arrivals``."""
    events = speed_events(messages).observe(
        "arrivals", F.count(F.lit(1)).alias("rows"), F.max("event_time_ts").alias("newest"))
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        counted_batches(path, width, late, compact_every))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that Spark's own windows dropped as late, as far as the query's recent progress goes back."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for state in progress["stateOperators"])
