"""Cart totals on a stream that are put right when events arrive late.

A batch of events may hold some that belong before events replayed earlier. What a cart held is kept in versions, one
per batch that touched it, each valid up to a place in event time. A batch goes back to the cart's last valid version before
its own first event, replays the logged events from there on together with the new ones, and writes the totals that
came out differently: the old value is retracted, the new one issued. Folders below ``path``, each with ``batch_id=N``, so that
writing a batch again after a failure changes nothing:

* ``totals``: issued and retracted totals, the changelog;
* ``log/bucket=B``: events with their totals as last issued; ``contents/bucket=B``: versions;
* ``log_base``, ``base`` and ``horizon``, every so many batches: log and versions as far as they are still needed;
* ``too_late``: events from before the horizon, which is ``late`` before the newest event at the last base.

Buckets are hashes of the cart, so a batch reads only the buckets of its own carts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.files import delete, exists, numbered_folders
from clickloom.operators.carts import CART_EVENTS, carried_replay
from clickloom.session import cleared, settle
from clickloom.sources.snapshots import newest_finished
from clickloom.streaming.buckets import BUCKETS, buckets_in, write_buckets

PLACE = "event_time TIMESTAMP, source_partition INT, source_offset BIGINT, event_id STRING, arrived BIGINT, row BIGINT"
EVENT = f"cart_id STRING, event_name STRING, product_id STRING, quantity BIGINT, price DOUBLE, {PLACE}"
LOG = f"{EVENT}, replayed_qty BIGINT, replayed_value DOUBLE"
TOTALS = f"{LOG}, change STRING"
_STRUCT = "STRUCT<" + ", ".join(f"{p.split()[0]}: {p.split()[1]}" for p in PLACE.split(", ")) + ">"
#: ``upto`` is the place of the last event in a version, ``since`` that of the first event the batch brought.
VERSIONS = (f"cart_id STRING, version BIGINT, product_id STRING, quantity BIGINT, worth DECIMAL(38,6), "
            f"upto {_STRUCT}, since {_STRUCT}")


def _names(schema: str) -> list[str]:
    found, depth = [], 0
    for part in schema.split(", "):
        if depth == 0:
            found.append(part.split()[0])
        depth += part.count("<") - part.count(">")
    return found


#: Event time, the place on the topic, the id, and the arrival for events equal in all of these.
ORDER = _names(PLACE)


def _at() -> Column:
    return F.struct(*ORDER)


def shaped(batch: DataFrame, batch_id: int) -> DataFrame:
    """Cart events of a batch in the log's shape, numbered."""
    known = batch.columns
    own = {"arrived": F.lit(batch_id), "row": F.monotonically_increasing_id()}
    kinds = dict(p.split() for p in EVENT.split(", "))
    rows = batch.filter(F.col("cart_id").isNotNull() & F.col("event_name").isin(*CART_EVENTS))
    return rows.select(*[own.get(c, F.col(c) if c in known else F.lit(None)).cast(kind).alias(c)
                         for c, kind in kinds.items()])


def _stored(spark: SparkSession, path: str, name: str, base_name: str, schema: str, before: int,
            buckets: list[int] | None) -> DataFrame:
    """Rows of the newest base before a batch and of the batches after it, with ``batch_id``; of some buckets only, if named."""
    base = newest_finished(spark, f"{path}/base", before)
    full = f"{schema}, batch_id BIGINT, bucket INT"
    rows = spark.createDataFrame([], full)
    if exists(spark, f"{path}/{name}"):
        rows = spark.read.schema(full).parquet(f"{path}/{name}").filter(
            (F.col("batch_id") < before) & (F.col("batch_id") > (-1 if base is None else base)))
    if base is not None:
        covered = spark.read.schema(f"{schema}, bucket INT").parquet(f"{path}/{base_name}/batch_id={base}")
        rows = rows.unionByName(covered.withColumn("batch_id", F.lit(base).cast("bigint")))
    return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))


def read_versions(spark: SparkSession, path: str, before: int, buckets: list[int] | None = None) -> DataFrame:
    return _stored(spark, path, "contents", "base", VERSIONS, before, buckets).drop("batch_id", "bucket")


def _issued_last(rows: DataFrame) -> DataFrame:
    """Of each event the row of the newest batch."""
    newest = F.max("batch_id").over(Window.partitionBy("arrived", "row"))
    return rows.withColumn("_newest", newest).filter(F.col("batch_id") == F.col("_newest")).select(*_names(LOG))


def read_log(spark: SparkSession, path: str, before: int, buckets: list[int] | None = None) -> DataFrame:
    """Logged events with their totals as issued last."""
    rows = _stored(spark, path, "log", "log_base", LOG, before, buckets)
    base = newest_finished(spark, f"{path}/base", before)
    later = [n for n in numbered_folders(spark, f"{path}/log", "batch_id") if (-1 if base is None else base) < n < before]
    # A base has each event once, and so has a batch.
    if len(later) + (base is not None) < 2:
        return rows.select(*_names(LOG))
    return _issued_last(rows)


def horizon(spark: SparkSession, path: str, before: int) -> Column:
    """The time up to which nothing can be repaired any more, at the newest base before a batch; null without one."""
    base = newest_finished(spark, f"{path}/base", before)
    if base is None:
        return F.lit(None).cast("timestamp")
    return spark.read.schema("horizon TIMESTAMP").parquet(f"{path}/horizon/batch_id={base}").agg(F.max("horizon").alias("h")).scalar()


def valid_versions(versions: DataFrame) -> DataFrame:
    """``cart_id, version, upto, empty`` of the versions that no later batch has gone back behind."""
    heads = versions.groupBy("cart_id", "version", "upto", "since").agg(F.count("product_id").alias("_products"))
    later = Window.partitionBy("cart_id").orderBy(F.desc("version")).rowsBetween(Window.unboundedPreceding, -1)
    cut = heads.withColumn("_cut", F.min("since").over(later))
    return cut.filter(F.col("_cut").isNull() | (F.col("upto") < F.col("_cut"))).select(
        "cart_id", "version", "upto", (F.col("_products") == 0).alias("empty"))


def _newest(versions: DataFrame) -> DataFrame:
    """Of each cart the version that reaches furthest."""
    return versions.groupBy("cart_id").agg(F.max_by(F.struct("version", "upto", "empty"), F.struct("upto", "version")).alias("_v")).select(
        "cart_id", "_v.*")


def repaired_batches(path: str, late: timedelta = timedelta(days=1), compact_every: int = 50,
                     buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback. A new checkpoint counts its batches anew and needs a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(n > batch_id for n in numbered_folders(spark, f"{path}/contents", "batch_id")):
            raise ValueError(f"{path} holds batches after {batch_id}; a new checkpoint needs a new folder")
        with cleared(spark):
            _repair(spark, path, settle(shaped(batch, batch_id), "arrived"), batch_id, buckets)
        if batch_id % compact_every == compact_every - 1:
            with cleared(spark):
                _compact(spark, path, batch_id, late, buckets)

    return write


def _repair(spark: SparkSession, path: str, arrived: DataFrame, batch_id: int, buckets: int) -> None:
    limit = horizon(spark, path, batch_id)
    in_time = limit.isNull() | F.coalesce(F.col("event_time") > limit, F.lit(False))
    arrived.filter(~in_time).write.mode("overwrite").parquet(f"{path}/too_late/batch_id={batch_id}")
    fresh = arrived.filter(in_time)
    since = settle(fresh.groupBy("cart_id").agg(F.min(_at()).alias("_since")), "since")
    read = buckets_in(since, "cart_id", buckets)

    versions = read_versions(spark, path, batch_id, read).join(since, "cart_id")
    start = settle(_newest(valid_versions(versions).join(since, "cart_id").filter(F.col("upto") < F.col("_since"))), "start")
    held = versions.join(start.select("cart_id", "version"), ["cart_id", "version"]).select(
        "cart_id", "product_id", "quantity", "worth")
    back_to = since.select("cart_id").join(start.select("cart_id", "upto"), "cart_id", "left")
    old = read_log(spark, path, batch_id, read).join(back_to, "cart_id").filter(F.col("upto").isNull() | (_at() > F.col("upto")))
    events = fresh.select("*", F.lit(None).cast("bigint").alias("_qty"), F.lit(None).cast("double").alias("_value")).unionByName(
        old.select(*_names(EVENT), F.col("replayed_qty").alias("_qty"), F.col("replayed_value").alias("_value")))

    totals, after = carried_replay(events, held, ORDER)
    changed = totals.filter((F.col("arrived") == batch_id) | ~F.col("_qty").eqNullSafe(F.col("replayed_qty"))
                            | ~F.col("_value").eqNullSafe(F.col("replayed_value")))
    write_buckets(changed.select(*_names(LOG)), "cart_id", f"{path}/log/batch_id={batch_id}", buckets)
    retracted = changed.filter(F.col("arrived") < batch_id).select(
        *_names(EVENT), F.col("_qty").alias("replayed_qty"), F.col("_value").alias("replayed_value"), F.lit("retracted").alias("change"))
    changed.select(*_names(LOG), F.lit("issued").alias("change")).unionByName(retracted).write.mode("overwrite").parquet(
        f"{path}/totals/batch_id={batch_id}")
    reach = totals.filter("__tail").groupBy("cart_id").agg(F.max(_at()).alias("upto")).join(since, "cart_id")
    write_buckets(after.join(reach, "cart_id").select(
        "cart_id", F.lit(batch_id).cast("bigint").alias("version"), "product_id", "quantity", "worth", "upto",
        F.col("_since").alias("since")), "cart_id", f"{path}/contents/batch_id={batch_id}", buckets)


def _compact(spark: SparkSession, path: str, batch_id: int, late: timedelta, buckets: int) -> None:
    """Log and versions as far as events from after the new horizon need them.

    Each cart keeps its last version up to the horizon, the events after that, and its newest version; a cart that was empty by
    then keeps no version. What the base before covers is deleted; a rerun of this batch still needs the rest.
    """
    earlier = newest_finished(spark, f"{path}/base", batch_id)
    versions, log = read_versions(spark, path, batch_id + 1), read_log(spark, path, batch_id + 1)
    times = _stored(spark, path, "log", "log_base", LOG, batch_id + 1, None)
    newest = F.max("event_time") - F.expr(f"INTERVAL {int(late.total_seconds())} SECONDS")
    times.agg(newest.alias("horizon")).select(F.greatest("horizon", horizon(spark, path, batch_id)).alias("horizon")).write.mode(
        "overwrite").parquet(f"{path}/horizon/batch_id={batch_id}")
    limit = spark.read.schema("horizon TIMESTAMP").parquet(f"{path}/horizon/batch_id={batch_id}").agg(F.max("horizon").alias("h")).scalar()

    valid = settle(valid_versions(versions), "valid")
    settled = settle(_newest(valid.filter(F.coalesce(F.col("upto.event_time") <= limit, F.col("upto.event_time").isNull()))), "settled")
    kept = settled.filter(~F.col("empty")).unionByName(_newest(valid).join(
        settled.select("cart_id", "version"), ["cart_id", "version"], "left_anti")).select("cart_id", "version")
    rest = log.join(settled.select("cart_id", "upto"), "cart_id", "left").filter(F.col("upto").isNull() | (_at() > F.col("upto")))
    write_buckets(rest.select(*_names(LOG)), "cart_id", f"{path}/log_base/batch_id={batch_id}", buckets)
    write_buckets(versions.join(kept, ["cart_id", "version"], "left_semi").select(*_names(VERSIONS)),
                  "cart_id", f"{path}/base/batch_id={batch_id}", buckets)
    if earlier is None:
        return
    for name, last in (("contents", earlier), ("log", earlier), ("base", earlier - 1), ("log_base", earlier - 1), ("horizon", earlier - 1)):
        for n, folder in numbered_folders(spark, f"{path}/{name}", "batch_id").items():
            if n <= last:
                delete(spark, folder)


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Every total issued or retracted (``change``), with the ``batch_id`` that did so."""
    return spark.read.schema(f"{TOTALS}, batch_id BIGINT").parquet(f"{path}/totals")


def read_repaired(spark: SparkSession, path: str) -> DataFrame:
    """The totals as they stand: of each event those issued last."""
    return _issued_last(read_corrections(spark, path).filter("change = 'issued'"))


def read_too_late(spark: SparkSession, path: str) -> DataFrame:
    """Events that came after the horizon had passed them; they are in no total."""
    return spark.read.schema(f"{EVENT}, batch_id BIGINT").parquet(f"{path}/too_late")


def start_repaired_replay(events: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                          trigger: str | None = None, late: timedelta = timedelta(days=1), compact_every: int = 50,
                          buckets: int = BUCKETS) -> StreamingQuery:
    """Cart totals after every event of a stream, as ``operators.carts.cart_replay`` gives them for all events in order.

    Events up to ``late`` behind the newest one are put in their place whenever they arrive. Those further behind may be
    left out once a base is written, and are then in ``read_too_late``.
    """
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        repaired_batches(path, late, compact_every, buckets))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
