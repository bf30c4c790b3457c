"""Order lines and the product catalogue, taken from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.measures import is_purchase
from clickloom.functions.scalars import round_even


def order_lines(events: DataFrame) -> DataFrame:
    """One row per purchased item of the event table; the line total is recomputed from price and quantity."""
    items = (
        events.filter(is_purchase())
        .select("event_id", "order.order_id", "event_time", F.posexplode("items").alias("line", "item"))
    )
    price, quantity = F.col("item.price"), F.col("item.quantity")
    return items.select(
        "event_id", "order_id", "event_time", "line", "item.product_id", "item.name",
        "item.category", price.alias("price"), quantity.alias("quantity"),
        round_even(price * quantity).alias("line_total"), F.col("item.line_total").alias("recorded_total"))


def line_total_mismatches(lines: DataFrame) -> DataFrame:
    """Order lines whose recorded total is not price times quantity, or of which one of the two is missing."""
    same = F.abs(F.col("recorded_total") - F.col("line_total")) < 0.005
    return lines.filter(~F.coalesce(same, F.lit(False)))


def product_sales(lines: DataFrame) -> DataFrame:
    """Purchases per product from the order lines: orders, units and revenue."""
    return (
        lines.filter(F.col("product_id").isNotNull()).groupBy("product_id")
        .agg(
            F.count("*").alias("lines"), F.countDistinct("order_id").alias("orders"),
            F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue"))
        .orderBy(F.desc("revenue"), "product_id")
    )


def product_catalog(events: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Latest known price, name and category per product, from events and order lines.

    Every attribute keeps its own latest value, as events carry a price but no name. Ties in time
    go to the larger value.
    """
    absent = F.lit(None).cast("string")
    seen = events.select(
        "product_id", "event_time", "price", absent.alias("name"), absent.alias("category"))
    if lines is not None:
        seen = seen.unionByName(lines.select("product_id", "event_time", "price", "name", "category"))
    # A product's attributes change rarely. One hashed row per product and combination is all that
    # is shuffled and sorted; picking latest texts right away would sort every event.
    attributes = ["price", "name", "category"]
    combined = (
        seen.filter(F.col("product_id").isNotNull()).groupBy("product_id", *attributes)
        .agg(F.max("event_time").alias("seen_at"))
    )

    def latest(name: str):
        at = F.when(F.col(name).isNotNull(), F.struct("seen_at", name))
        return F.max_by(name, at).alias(name)

    return combined.groupBy("product_id").agg(
        *[latest(name) for name in attributes], F.max("seen_at").alias("last_seen"))
