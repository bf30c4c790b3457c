"""Daily rollups of the dimension reports, kept up to date day by day.

A rollup has one row per day and value: sums, which add up over any days, and sketches of visitors, sessions, orders and
buyers, whose unions estimate distinct counts over any days without looking at the events again. With 2^12 registers the
relative standard error of an estimate is about 1.6 %; ``operators.reports.dimension_report`` counts exactly on demand.

Folder layout below ``path``: ``rollup/event_date=D``; ``done``, the time up to which events were rolled up; and
``dirty/mark=N/...``, days that late events have touched since.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.files import delete, exists, numbered_folders
from clickloom.functions.dimensions import dimension
from clickloom.functions.measures import is_event, is_purchase, purchase_amount, purchase_order, purchase_user, total_sales, units_sold
from clickloom.functions.scalars import utc_date
from clickloom.functions.timerange import TimeRange
from clickloom.sinks.tables import write_watermark
from clickloom.sources.tables import batch_watermark

#: Logarithm of a sketch's registers.
REGISTERS = 12

SUMS = ("events", "product_views", "add_to_cart", "begin_checkout", "purchase_events", "units_sold", "revenue_usd", "total_sales_usd")
SKETCHES = ("users", "sessions", "orders", "buyers")


def _sums() -> list[Column]:
    def on_purchase(value: Column) -> Column:
        return F.sum(F.when(is_purchase(), value).otherwise(F.lit(0)))

    counted = {"product_views": "product_view", "add_to_cart": "add_to_cart", "begin_checkout": "begin_checkout",
               "purchase_events": "purchase"}
    return [F.count("*").alias("events"), *[F.count_if(is_event(n)).alias(c) for c, n in counted.items()],
            on_purchase(units_sold()).cast("bigint").alias("units_sold"), on_purchase(purchase_amount()).alias("revenue_usd"),
            on_purchase(total_sales()).alias("total_sales_usd")]


def daily_rollup(events: DataFrame, by: str, registers: int = REGISTERS) -> DataFrame:
    """``event_date, dimension``, the sums, and a sketch for each distinct count. Sketches merge before the shuffle."""
    counted = {"users": F.col("user_id"), "sessions": F.col("session_id"), "orders": purchase_order(), "buyers": purchase_user()}
    chosen = dimension(by)
    rows = events.filter(is_purchase()) if chosen.purchase_only else events
    return rows.groupBy(utc_date(F.col("event_time")).alias("event_date"), chosen.column().alias("dimension")).agg(
        *_sums(), *[F.hll_sketch_agg(c.cast("string"), registers).alias(n) for n, c in counted.items()])


def report_from(rollup: DataFrame, period: TimeRange | None = None) -> DataFrame:
    """The dimension's report over whole days, or all: exact sums, estimated distinct counts. No event is read."""
    rows = rollup
    if period is not None:
        if any(t.timestamp() % 86_400 for t in (period.start, period.end)):
            raise ValueError("a rollup answers whole UTC days; use dimension_report for other ranges")
        first, last = (F.date_from_unix_date(F.lit(int(t.timestamp() // 86_400))) for t in (period.start, period.end))
        rows = rows.filter((F.col("event_date") >= first) & (F.col("event_date") < last))
    return rows.groupBy("dimension").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in SKETCHES]).orderBy(
        F.desc("total_sales_usd"), F.desc("revenue_usd"), F.desc("orders"), F.desc("events"), "dimension")


def mark_dirty(late: DataFrame, path: str) -> None:
    """Notes the days of late events, so that the next refresh rolls them up again."""
    days = late.select(utc_date(F.col("event_time")).alias("day")).filter(F.col("day").isNotNull()).distinct()
    days.coalesce(1).write.parquet(f"{path}/dirty/mark={time.time_ns()}")


def stale_days(spark: SparkSession, events: DataFrame, path: str) -> list[str]:
    """Days to roll up: from that of the stored time on, and those marked. At most one entry a day of the table.

    Only ``event_date`` is read, which a table partitioned by it answers from its folders.
    """
    days = events.select(F.col("event_date").alias("day")).filter(F.col("day").isNotNull()).distinct()
    if not exists(spark, f"{path}/done"):
        return sorted(str(r["day"]) for r in days.collect())
    done = batch_watermark(spark, f"{path}/done").agg(F.max("watermark").alias("at")).scalar()
    found = {str(r["day"]) for r in days.filter(F.col("day") >= F.coalesce(utc_date(done), F.col("day"))).collect()}
    for folder in numbered_folders(spark, f"{path}/dirty", "mark").values():
        found |= {str(r["day"]) for r in spark.read.schema("day DATE").parquet(folder).collect()}
    return sorted(found)


def of_days(events: DataFrame, days: list[str]) -> DataFrame:
    """Events of some days of a table partitioned by ``event_date``: other days' files are not read."""
    return events.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False))


def refresh_rollup(spark: SparkSession, events: DataFrame, path: str, by: str, registers: int = REGISTERS) -> list[str]:
    """Rolls up the stale days of ``events`` (with event_date) and replaces just those. Returns them.

    Marks made while this runs stay for the next time. Stopped halfway it starts over with the same days.
    """
    marks = list(numbered_folders(spark, f"{path}/dirty", "mark").values())
    days = stale_days(spark, events, path)
    if days:
        rows = of_days(events, days)
        daily_rollup(rows, by, registers).hint("rebalance", "event_date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(f"{path}/rollup")
        earlier = batch_watermark(spark, f"{path}/done").select(F.col("watermark").alias("event_time")) if exists(
            spark, f"{path}/done") else None
        newest = rows.agg(F.max("event_time").alias("event_time"))
        both = newest if earlier is None else newest.unionByName(earlier).agg(F.max("event_time").alias("event_time"))
        reached = both.first()["event_time"]
        write_watermark(spark.createDataFrame([(reached,)], "event_time timestamp"), f"{path}/done")
    for folder in marks:
        delete(spark, folder)
    return days


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rollup")
