"""Cart totals kept up to date on a stream.

Every micro-batch is replayed by the batch operator, which splits busy carts, onto what its carts held before. A batch
owns its folders, so writing it again after a failure changes nothing: ``totals/batch_id=N`` has the replayed events,
``contents/batch_id=N`` all that the carts of the batch hold after it, and ``base/batch_id=N``, every so many batches, all
carts that hold anything. Emptied carts are not in a base. Contents and bases are cut into hash buckets of the cart, and a batch
reads those of its own carts. Events that arrive in a later batch than their successors are replayed then;
``streaming.repairs`` puts them in their place instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.files import delete, exists, numbered_folders
from clickloom.operators.carts import carried_replay
from clickloom.session import cleared, settle
from clickloom.sources.snapshots import newest_finished
from clickloom.streaming.buckets import buckets_in, write_buckets

TOTALS = ("cart_id STRING, event_id STRING, event_name STRING, event_time TIMESTAMP, "
          "replayed_qty BIGINT, replayed_value DOUBLE")
CONTENTS = "cart_id STRING, product_id STRING, quantity BIGINT, worth DECIMAL(38,6)"


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The replayed events of all batches."""
    return spark.read.schema(f"{TOTALS}, batch_id BIGINT").parquet(f"{path}/totals").drop("batch_id")


def contents_before(spark: SparkSession, path: str, batch_id: int, buckets: list[int] | None = None) -> DataFrame:
    """What carts held when a batch began: of each cart the rows of the last batch that touched it. Only the carts of
    some buckets, if named."""
    rows = spark.createDataFrame([], f"{CONTENTS}, batch_id BIGINT, bucket INT")
    if exists(spark, f"{path}/contents"):
        rows = spark.read.schema(f"{CONTENTS}, batch_id BIGINT, bucket INT").parquet(f"{path}/contents")
        rows = rows.filter(F.col("batch_id") < batch_id)
    base = newest_finished(spark, f"{path}/base", batch_id)
    if base is not None:
        covered = spark.read.schema(f"{CONTENTS}, bucket INT").parquet(f"{path}/base/batch_id={base}")
        rows = rows.filter(F.col("batch_id") > base).unionByName(
            covered.withColumn("batch_id", F.lit(base).cast("bigint")))
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    rows = rows.drop("bucket")
    newest = rows.groupBy("cart_id").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, ["cart_id", "batch_id"]).filter(F.col("product_id").isNotNull()).drop("batch_id")


def _compact(spark: SparkSession, path: str, batch_id: int) -> None:
    """A base as of the batch. What the base before it covers goes; a rerun of this batch still needs the rest."""
    earlier = newest_finished(spark, f"{path}/base", batch_id)
    write_buckets(contents_before(spark, path, batch_id + 1), "cart_id", f"{path}/base/batch_id={batch_id}")
    if earlier is None:
        return
    for n, folder in numbered_folders(spark, f"{path}/contents", "batch_id").items():
        if n <= earlier:
            delete(spark, folder)
    for n, folder in numbered_folders(spark, f"{path}/base", "batch_id").items():
        if n < earlier:
            delete(spark, folder)


def replay_batches(path: str, compact_every: int = 50) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback. A new checkpoint counts its batches anew and needs a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(n > batch_id for n in numbered_folders(spark, f"{path}/contents", "batch_id")):
            raise ValueError(f"{path} holds batches after {batch_id}; a new checkpoint needs a new folder")
        with cleared(spark):
            batch = settle(batch, "batch")
            read = buckets_in(batch.filter(F.col("cart_id").isNotNull()), "cart_id")
            totals, after = carried_replay(batch, contents_before(spark, path, batch_id, read))
            names = [part.split()[0] for part in TOTALS.split(", ")]
            totals.select(*names).write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")
            write_buckets(after, "cart_id", f"{path}/contents/batch_id={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            _compact(spark, path, batch_id)

    return write


def start_cart_replay(events: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                      trigger: str | None = None, compact_every: int = 50) -> StreamingQuery:
    """Cart totals after every event of a stream, as ``operators.carts.cart_replay`` gives them.

    Events are ordered within a micro-batch; one that arrives in a later batch is replayed then.
    """
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        replay_batches(path, compact_every))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
