"""Event schemas and the fixed vocabulary of the clickstream."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


# Event names in funnel order.
FUNNEL_STAGES = (
    "product_view",
    "click",
    "add_to_cart",
    "update_cart",
    "remove_from_cart",
    "begin_checkout",
    "checkout_progress",
    "purchase",
)

# Fixed value: the only event time format the parser accepts.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"

# Fixed value: key prefix of the per-product count hashes.
SNAPSHOT_PREFIX = "realtime:stats"

EVENT_TABLE = "ecommerce_events"

_S, _I, _D = StringType(), IntegerType(), DoubleType()

ORDER_ITEM = _struct(product_id=_S, name=_S, category=_S, price=_D, quantity=_I, line_total=_D)

# Flat event as produced on the topic.
EVENT_V1 = _struct(
    event_id=_S, event_time=_S, event_name=_S, user_id=_S, session_id=_S, device=_S, currency=_S,
    product_id=_S, quantity=_I, price=_D, cart_id=_S, checkout_id=_S, order_id=_S,
    cart_items_qty=_I, cart_value=_D, revenue=_D, page_url=_S, referrer=_S,
    items=ArrayType(ORDER_ITEM),
)

# What the running counts need of it; parsing fewer fields is cheaper.
EVENT_SPEED = StructType(
    [EVENT_V1[name] for name in (
        "event_id", "event_time", "event_name", "user_id", "product_id", "price", "revenue")]
)

MARKETING = _struct(channel=_S, source=_S, medium=_S, campaign_name=_S)
CUSTOMER = _struct(customer_id=_S, segment=_S, loyalty_tier=_S, is_member=BooleanType())
GEO = _struct(country=_S, city=_S)
PRODUCT = _struct(product_id=_S, category=_S, brand=_S, price=_D, quantity=_I)
DEVICE = _struct(device_type=_S, os=_S)
ORDER = _struct(order_id=_S, status=_S, payment_method=_S, payment_provider=_S, total=_D)

_CARRIED = dict(
    cart_id=_S, checkout_id=_S, cart_items_qty=_I, cart_value=_D, currency=_S, page_url=_S,
    referrer=_S, items=ArrayType(ORDER_ITEM),
)

# Nested event as JSON, before its time is parsed.
EVENT_V2_JSON = _struct(
    event_id=_S, event_time=_S, event_name=_S, user_id=_S, session_id=_S, product_id=_S,
    revenue=_D, quantity=_I, price=_D, event_source=_S, marketing=MARKETING, customer=CUSTOMER,
    geo=GEO, product=PRODUCT, device=DEVICE, order=ORDER, **_CARRIED,
)

# The event table.
EVENT_V2 = StructType(
    [StructField(f.name, TimestampType() if f.name == "event_time" else f.dataType, True)
     for f in EVENT_V2_JSON]
    + [StructField("event_date", DateType(), True),
       # Where the message stood on the topic, if that is known: the order within a second.
       StructField("source_partition", IntegerType(), True), StructField("source_offset", LongType(), True)]
)

SNAPSHOT = _struct(product_id=_S, event_name=_S, count=LongType())
