"""The dimensions reports can group by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"


@dataclass(frozen=True)
class Dimension:
    """Grouping expression by the columns it falls back through, in order."""

    group: str
    columns: tuple[str, ...]
    purchase_only: bool = False

    def column(self) -> Column:
        return F.coalesce(*[F.col(c) for c in self.columns], F.lit(UNKNOWN))


@dataclass(frozen=True)
class MembershipDimension(Dimension):
    """Unknown membership counts as none."""

    def column(self) -> Column:
        return F.when(F.col(self.columns[0]), "member").otherwise("non_member")


# Report dimensions, and their source columns.
DIMENSIONS: dict[str, Dimension] = {
    "channel": Dimension("marketing", ("marketing.channel",)),
    "source": Dimension("marketing", ("marketing.source",)),
    "medium": Dimension("marketing", ("marketing.medium",)),
    "campaign": Dimension("marketing", ("marketing.campaign_name",)),
    "segment": Dimension("customer", ("customer.segment",)),
    "loyalty_tier": Dimension("customer", ("customer.loyalty_tier",)),
    "membership": MembershipDimension("customer", ("customer.is_member",)),
    "customer_country": Dimension("customer", ("geo.country",)),
    "product": Dimension("product", ("product_id", "product.product_id")),
    "category": Dimension("product", ("product.category",)),
    "brand": Dimension("product", ("product.brand",)),
    "device_type": Dimension("ops", ("device.device_type",)),
    "os": Dimension("ops", ("device.os",)),
    "event_source": Dimension("ops", ("event_source",)),
    "country": Dimension("ops", ("geo.country",)),
    "city": Dimension("ops", ("geo.city",)),
    "order_status": Dimension("ops", ("order.status",), True),
    "payment_method": Dimension("ops", ("order.payment_method",), True),
    "payment_provider": Dimension("ops", ("order.payment_provider",), True),
}

# The metrics each dimension group may be ranked by.
GROUP_METRICS: dict[str, tuple[str, ...]] = {
    "marketing": ("total_sales_usd", "revenue_usd", "units_sold", "orders", "sessions", "users",
                  "events"),
    "customer": ("total_sales_usd", "revenue_usd", "units_sold", "orders", "buyers", "users",
                 "events"),
    "product": ("total_sales_usd", "revenue_usd", "units_sold", "orders", "buyers",
                "purchase_events", "begin_checkout", "add_to_cart", "product_views"),
    "ops": ("total_sales_usd", "revenue_usd", "units_sold", "orders", "users", "sessions",
            "events"),
}


def dimension(name: str) -> Dimension:
    if name not in DIMENSIONS:
        raise ValueError(f"unknown dimension {name!r}; known: {', '.join(DIMENSIONS)}")
    return DIMENSIONS[name]


def check_metric(name: str, metric: str) -> str:
    """The metric, if the dimension's group offers it."""
    allowed = GROUP_METRICS[dimension(name).group]
    if metric not in allowed:
        raise ValueError(f"{name} cannot be ranked by {metric!r}; choose from {', '.join(allowed)}")
    return metric
