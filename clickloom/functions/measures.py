"""Money and quantity measures over the event table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_event(name: str) -> Column:
    return F.col("event_name") == F.lit(name)


def is_purchase() -> Column:
    return is_event("purchase")


def purchase_amount() -> Column:
    return F.coalesce(F.col("revenue"), F.col("order.total"), F.lit(0.0))


def units_sold() -> Column:
    return F.coalesce(F.col("quantity"), F.col("product.quantity"), F.lit(1))


def unit_price() -> Column:
    return F.coalesce(F.col("price"), F.col("product.price"), F.lit(0.0))


def total_sales() -> Column:
    return units_sold() * unit_price()


def purchase_order() -> Column:
    """The order id, on purchases only."""
    return F.when(is_purchase(), F.col("order.order_id"))


def purchase_user() -> Column:
    return F.when(is_purchase(), F.col("user_id"))
