"""The price history of products, and order lines sold at another price than the catalogue's at that time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.scans import CHUNK, laid_out, last_before


def price_history(seen: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """Validity intervals ``product_id, price, valid_from, valid_to`` of the prices in ``seen(product_id, event_time, price, ...)``.

    ``order`` orders a product's rows completely and begins with event_time. A price seen again unchanged opens no
    interval; the last one is open (null). Rows without a product, price or time are left out. A product with a large
    part of the rows is looked back over in ranges.
    """
    rows = seen.filter(F.col("product_id").isNotNull() & F.col("price").isNotNull() & F.col("event_time").isNotNull()).select(
        "product_id", *order, "price")
    changes = last_before(rows, "product_id", order, "__was", F.col("price"), ranges).filter(
        F.col("__was").isNull() | (F.col("__was") != F.col("price")))
    # The change after each one, by looking back from the end.
    place = F.struct(*order)
    back = changes.select("product_id", place.alias("__at"), "price")
    return _next(back, ranges).select(
        "product_id", "price", F.col("__at.event_time").alias("valid_from"), F.col("__next.event_time").alias("valid_to"))


def _next(changes: DataFrame, ranges: int | None) -> DataFrame:
    """``__next``, the place of the product's change that follows."""
    rows = laid_out(changes, "product_id", ["__at"], ranges)
    local = Window.partitionBy("product_id", CHUNK).orderBy("__at")
    later = Window.partitionBy("product_id").orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each product and range.
    firsts = rows.groupBy("product_id", CHUNK).agg(F.min("__at").alias("__first"))
    after = firsts.select("product_id", CHUNK, F.last("__first").over(later).alias("__after"))
    return rows.withColumn("__in", F.lead("__at").over(local)).join(after, ["product_id", CHUNK]).withColumn(
        "__next", F.coalesce("__in", "__after"))


def price_then(lines: DataFrame, seen: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """``lines`` with ``catalogue_price``: the price of the product seen last at the line's time or before.

    Both tables have product_id, event_time, price and the other columns of ``order``, which orders a product's rows
    completely; at one time what was seen counts before a line. Null where nothing was seen yet, or without a product.
    Ranges of (product, time) hold both tables' rows, so a product with a third of them is no single task.
    """
    named = lines.filter(F.col("product_id").isNotNull() & F.col("event_time").isNotNull())
    points = seen.filter(F.col("product_id").isNotNull() & F.col("price").isNotNull() & F.col("event_time").isNotNull())
    key = ["event_time", "__is_line", *[c for c in order if c != "event_time"]]
    both = named.withColumn("__is_line", F.lit(True)).unionByName(
        points.select("product_id", *order, F.col("price").alias("__seen")).withColumn("__is_line", F.lit(False)), allowMissingColumns=True)
    found = last_before(both, "product_id", key, "catalogue_price", F.col("__seen"), ranges).filter("__is_line")
    rest = lines.filter(F.col("product_id").isNull() | F.col("event_time").isNull()).withColumn(
        "catalogue_price", F.lit(None).cast(seen.schema["price"].dataType))
    return found.select(*lines.columns, "catalogue_price").unionByName(rest)


def price_mismatches(priced: DataFrame, by: Column | float = 0.005) -> DataFrame:
    """Lines sold at another price than the catalogue's at that time."""
    return priced.filter(F.abs(F.col("price") - F.col("catalogue_price")) >= by)
