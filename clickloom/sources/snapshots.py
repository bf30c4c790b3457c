"""Reading the running counts.

A snapshot folder holds ``changes/batch_id=N`` (absolute counts of the keys that changed in
micro-batch N; see ``sinks.snapshots`` for N) and, once compacted, ``base/batch_id=N`` (every key as of batch N).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.files import exists, numbered_folders
from clickloom.functions.scalars import product_of_key, snapshot_key
from clickloom.schemas import SNAPSHOT, SNAPSHOT_PREFIX


CHANGES = "product_id STRING, event_name STRING, count BIGINT, batch_id BIGINT"


def newest_finished(spark: SparkSession, path: str, before: int | None = None, key: str = "batch_id") -> int | None:
    """Highest batch id below a folder that was written to its end; of those before a batch, if named."""
    folders = numbered_folders(spark, path, key)
    for batch in sorted(folders, reverse=True):
        if (before is None or batch < before) and exists(spark, f"{folders[batch]}/_SUCCESS"):
            return batch
    return None


def newest_base(spark: SparkSession, path: str) -> int | None:
    return newest_finished(spark, f"{path}/base")


def read_changes(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Recorded counts with their ``batch_id``: the newest base and the changes after it; as of a batch, if named.

    A batch older than what ``sinks.snapshots.drop_compacted`` has left cannot be read any more and raises.
    """
    base = newest_finished(spark, f"{path}/base", None if as_of is None else as_of + 1)
    if as_of is not None and base is None and newest_base(spark, path) is not None and not any(
            n <= as_of for n in numbered_folders(spark, f"{path}/changes", "batch_id")):
        raise ValueError(f"{path} has been compacted beyond batch {as_of}")
    if not exists(spark, f"{path}/changes"):
        changes = spark.createDataFrame([], CHANGES)
    else:
        changes = spark.read.schema(CHANGES).parquet(f"{path}/changes")
    if as_of is not None:
        changes = changes.filter(F.col("batch_id") <= as_of)
    if base is None:
        return changes
    covered = (
        spark.read.schema(SNAPSHOT).parquet(f"{path}/base/batch_id={base}")
        .withColumn("batch_id", F.lit(base).cast("bigint"))
    )
    return covered.unionByName(changes.filter(F.col("batch_id") > base))


def read_snapshot(spark: SparkSession, path: str, product_id: str | None = None, as_of: int | None = None) -> DataFrame:
    """Latest count per product and event; one product's only, if named; as of a batch, if named."""
    changes = read_changes(spark, path, as_of)
    if product_id is not None:
        changes = changes.filter(F.col("product_id") == product_id)
    return latest_counts(changes)


def latest_counts(changes: DataFrame) -> DataFrame:
    """Counts are absolute, so the last batch that mentions a key wins."""
    return changes.groupBy("product_id", "event_name").agg(
        F.max_by("count", "batch_id").alias("count"))


def snapshot_changes(spark: SparkSession, path: str, after: int, upto: int) -> DataFrame:
    """Keys whose count changed after one batch and up to another: ``before`` (null if new), ``count`` and ``delta``.

    Only keys that batches in between mention are looked up; where a base covers those, all keys are compared.
    """
    now = read_snapshot(spark, path, as_of=upto)
    touched = read_changes(spark, path, upto).filter(F.col("batch_id") > after).select("product_id", "event_name").distinct()
    then = read_snapshot(spark, path, as_of=after).withColumnRenamed("count", "before")
    keys = ["product_id", "event_name"]
    return (now.join(touched, keys, "left_semi").join(then, keys, "left")
            .withColumn("delta", F.col("count") - F.coalesce("before", F.lit(0))).filter("delta != 0"))


def ordered_snapshot(snapshot: DataFrame) -> DataFrame:
    return snapshot.orderBy(F.desc("count"), "product_id", "event_name")


def clean_counts(raw: DataFrame) -> DataFrame:
    """Counts kept as text, as in a key-value export: drop those that are not integers."""
    count = F.col("count").try_cast("bigint")
    return raw.withColumn("count", count).filter(F.col("count").isNotNull()).select(*SNAPSHOT.names)


def to_hashes(snapshot: DataFrame, prefix: str = SNAPSHOT_PREFIX, most: int = 1000) -> DataFrame:
    """``key, stats`` rows: maps of event counts per product.

    A product with more than about ``most`` event names has several rows of one key, cut by a hash of the name, so no map
    grows with the vocabulary; writing a hash's fields in several goes gives the same hash.
    """
    named = snapshot.filter(F.col("event_name").isNotNull())
    sizes = named.groupBy("product_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("_rows"))
    part = F.pmod(F.xxhash64("event_name"), F.col("_rows")).alias("_part")
    entries = F.collect_list(F.struct("event_name", "count"))
    return (
        named.join(sizes, "product_id").groupBy("product_id", part).agg(F.map_from_entries(entries).alias("stats"))
        .select(snapshot_key(F.col("product_id"), prefix).alias("key"), "stats")
    )


def from_hashes(hashes: DataFrame) -> DataFrame:
    """Back from ``key, stats`` to one row per product and event."""
    return hashes.select(
        product_of_key(F.col("key")).alias("product_id"),
        F.explode("stats").alias("event_name", "count"),
    )
