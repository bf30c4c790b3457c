"""Checks of events against their contract: messages, orders, sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.measures import is_event, is_purchase
from clickloom.functions.scalars import parse_event_time, round_even
from clickloom.operators.carts import cart_replay, default_order, held_before
from clickloom.operators.parsing import parse_json
from clickloom.operators.scans import last_before
from clickloom.schemas import EVENT_V1, FUNNEL_STAGES
from clickloom.session import settle

# Fields each kind of event must carry.
COMMON_FIELDS = ("event_id", "user_id", "session_id", "device", "currency", "cart_id", "page_url",
                 "referrer")
REQUIRED_FIELDS: dict[str, tuple[str, ...]] = {
    "product_view": ("product_id", "price"),
    "click": ("product_id", "price"),
    "add_to_cart": ("product_id", "quantity", "price", "cart_items_qty", "cart_value"),
    "update_cart": ("product_id", "quantity", "price", "cart_items_qty", "cart_value"),
    "remove_from_cart": ("product_id", "quantity", "price", "cart_items_qty", "cart_value"),
    "begin_checkout": ("cart_items_qty", "cart_value", "checkout_id"),
    "checkout_progress": ("cart_items_qty", "cart_value", "checkout_id"),
    "purchase": ("cart_items_qty", "cart_value", "checkout_id", "order_id", "revenue", "items"),
}


def checked_messages(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed flat events with ``reasons``, the list of broken rules, and the raw text.

    Works row by row, on batches and streams alike.
    """
    parsed = parse_json(messages, EVENT_V1, (*keep, "value"))
    unreadable = reduce(lambda a, b: a & b, [F.col(f).isNull() for f in EVENT_V1.names])
    name = F.col("event_name")
    rules: list[Column] = [
        F.when(parse_event_time(F.col("event_time")).isNull(), "bad_time"),
        F.when(name.isNull(), "null_event_name"),
        F.when(~name.isin(*FUNNEL_STAGES), "unknown_event_name"),
    ]
    for field in EVENT_V1.names:
        if field in COMMON_FIELDS:
            rules.append(F.when(F.col(field).isNull(), f"missing:{field}"))
        needing = [event for event, fields in REQUIRED_FIELDS.items() if field in fields]
        if needing:
            rules.append(F.when(name.isin(*needing) & F.col(field).isNull(), f"missing:{field}"))
    broken = F.when(unreadable, F.array(F.lit("unparsable"))).otherwise(F.array_compact(F.array(*rules)))
    # Generated, so that filters on the reasons do not repeat the rules.
    return parsed.select("*", F.explode(F.array(broken)).alias("reasons"))


def valid_messages(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") == 0).drop("reasons")


def quarantined(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text and reasons of the messages that broke a rule."""
    return checked.filter(F.size("reasons") > 0).select(*keep, "value", "reasons")


def violation_counts(checked: DataFrame) -> DataFrame:
    reasons = checked.select("event_name", F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason", "event_name").agg(F.count("*").alias("events"))


def order_reconciliation(events: DataFrame) -> DataFrame:
    """Purchases of the event table whose revenue, cart value or quantity differs from the sum of their items.

    ``differing`` also names what is missing: ``missing:items``, ``missing:item_values`` (an item lacks its price or
    quantity) or a recorded total. The items are summed in one fold inside each row; nothing is exploded or shuffled.
    """
    # The fold's fields take the start's type, which allows no nulls: items without a value are counted instead.
    start = F.struct(F.lit(0.0).alias("worth"), F.lit(0).cast("bigint").alias("pieces"), F.lit(0).alias("blank"))
    folded = F.aggregate("items", start, lambda acc, x: F.struct(
        (acc["worth"] + F.coalesce(x["price"] * x["quantity"], F.lit(0.0))).alias("worth"),
        (acc["pieces"] + F.coalesce(x["quantity"], F.lit(0))).alias("pieces"),
        (acc["blank"] + F.when(x["price"].isNull() | x["quantity"].isNull(), 1).otherwise(0)).alias("blank")))
    # Generating the fold keeps the filter above it; it would repeat it otherwise.
    summed = events.filter(is_purchase()).select(
        "event_id", "order.order_id", "revenue", "cart_value", "cart_items_qty",
        F.coalesce(F.size("items") < 1, F.lit(True)).alias("no_items"), F.explode(F.array(folded)).alias("sums"))
    full = F.col("sums.blank") == 0
    summed = summed.withColumns({"items_value": F.when(full, round_even(F.col("sums.worth"))),
                                 "items_qty": F.when(full, F.col("sums.pieces"))})
    rules = [
        F.when(F.col("no_items"), "missing:items"),
        F.when(~F.col("no_items") & (F.col("sums.blank") > 0), "missing:item_values")]
    checks = {
        "revenue": F.abs(F.col("revenue") - F.col("items_value")) >= 0.005,
        "cart_value": F.abs(F.col("cart_value") - F.col("items_value")) >= 0.005,
        "cart_items_qty": F.col("cart_items_qty") != F.col("items_qty"),
    }
    for name, differs in checks.items():
        rules.append(F.when(F.col(name).isNull(), f"missing:{name}").when(~F.col("no_items") & differs, name))
    return (
        summed.withColumn("differing", F.array_compact(F.array(*rules))).filter(F.size("differing") > 0)
        .select("event_id", "order_id", "revenue", "cart_value", "cart_items_qty", "items_value",
                "items_qty", "differing")
    )


def session_stages(events: DataFrame) -> DataFrame:
    """First and last time and number of events per session and funnel stage."""
    return (
        events.filter(F.col("session_id").isNotNull() & F.col("event_name").isin(*FUNNEL_STAGES))
        .groupBy("session_id", "event_name")
        .agg(F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"),
             F.count("*").alias("events"))
    )


def cart_rule_violations(events: DataFrame, order: list[str] | None = None,
                         ranges: int | None = None) -> DataFrame:
    """Cart events that what the cart held does not allow, with ``reasons``.

    Updating and removing need the product in the cart, and a removal records the quantity it took out.
    """
    changing = F.col("event_name").isin("update_cart", "remove_from_cart")
    there = F.coalesce("held_qty", F.lit(0)) > 0
    reasons = F.array_compact(F.array(
        F.when(~there, "not_in_cart"),
        F.when(there & is_event("remove_from_cart") & ~F.col("quantity").eqNullSafe(F.col("held_qty")),
               "other_quantity_removed")))
    return (
        held_before(events, order, ranges).filter(changing).withColumn("reasons", reasons)
        .filter(F.size("reasons") > 0).select("cart_id", "event_id", "event_name", "held_qty", "reasons")
    )


CHECKOUT = ("begin_checkout", "checkout_progress", "purchase")


def session_violations(events: DataFrame, order: list[str] | None = None,
                       ranges: int | None = None) -> DataFrame:
    """Checkout events that the steps before them do not allow, with ``reasons``; one row per event.

    A checkout opens with begin_checkout and closes with the purchase. Whether the cart held anything comes from the
    cart replay, whose rows are the steps themselves; a step without a cart finds nothing in it.
    """
    order = order or default_order(events)
    fields = ["session_id", "event_name", *dict.fromkeys(["event_time", *order, "event_id"])]
    wanted = F.col("session_id").isNotNull() & F.col("event_name").isin(*CHECKOUT)
    held = cart_replay(events, order, ranges).filter(wanted).select(*fields, "replayed_qty")
    bare = events.filter(wanted & F.col("cart_id").isNull()).select(
        *fields, F.lit(0).cast("bigint").alias("replayed_qty"))
    state = F.when(is_event("begin_checkout"), 1).when(is_purchase(), 0)
    steps = last_before(settle(held.unionByName(bare), "steps"), "session_id", order, "__open", state, ranges)
    open_before = F.coalesce("__open", F.lit(0)) == 1
    reasons = F.array_compact(F.array(
        F.when(is_event("begin_checkout") & open_before, "checkout_already_open"),
        F.when(~is_event("begin_checkout") & ~open_before, "no_open_checkout"),
        F.when(~is_event("checkout_progress") & (F.coalesce("replayed_qty", F.lit(0)) <= 0), "empty_cart"),
    ))
    return (
        steps.withColumn("reasons", reasons).filter(F.size("reasons") > 0)
        .select("session_id", "event_id", "event_name", "event_time", "reasons")
    )
