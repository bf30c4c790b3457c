"""Parsing, contract checks, orders."""

import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators import commerce, parsing, quality
from clickloom.schemas import EVENT_V1, EVENT_V2

VIEW = dict(event_id="1", event_time="2026-02-28T10:00:00Z", event_name="product_view", user_id="U1",
            session_id="S", device="mobile", currency="USD", product_id="SKU1", price=2.5, cart_id="C",
            page_url="/", referrer="/")
ITEMS = [dict(product_id="SKU1", name="Ñandú", category="Electrónica", price=2.5, quantity=2, line_total=5.0),
         dict(product_id="SKU2", name="b", category="Ropa", price=1.1, quantity=3, line_total=3.3)]
BUY = {**VIEW, "event_id": "2", "event_name": "purchase", "product_id": None, "price": None, "order_id": "O",
       "checkout_id": "K", "cart_items_qty": 5, "cart_value": 8.3, "revenue": 8.3, "items": ITEMS}


def messages(spark, *events):
    lines = [(e if e is None or isinstance(e, str) else json.dumps(e, ensure_ascii=False),) for e in events]
    return spark.createDataFrame(lines, "value string")


def test_parser_keeps_what_is_readable(spark):
    found = parsing.parse_json(messages(
        spark, {**VIEW, "price": "x"}, {**VIEW, "event_id": 7}, "{", "[1]", "null", "text", None), EVENT_V1)
    rows = found.collect()
    assert (rows[0].price, rows[0].event_id, rows[1].event_id) == (None, "1", "7")
    assert all(v is None for row in rows[2:] for v in row)


def test_binary_messages(spark):
    raw = messages(spark, VIEW).select(F.col("value").cast("binary").alias("value"))
    assert parsing.speed_events(parsing.message_text(raw)).first().event_time_ts.hour == 10


def test_bad_times_are_dropped(spark):
    times = ["2026-02-28T10:00:00Z", "2026-02-28T10:00:00+02:00", "x", None]
    events = parsing.speed_events(messages(spark, *[{**VIEW, "event_time": t} for t in times]))
    assert events.count() == 1


def test_normalize_v1(spark):
    table = parsing.events_from_v1(messages(spark, VIEW, BUY))
    assert table.schema == EVENT_V2
    view, buy = table.orderBy("event_id").collect()
    assert view.device.device_type == "mobile" and view.order is None and view.marketing is None
    assert (buy.order.order_id, buy.order.total, len(buy["items"])) == ("O", 8.3, 2)
    assert str(view.event_date) == "2026-02-28"


def test_normalize_v2(spark):
    nested = dict(event_id="1", event_time="2026-02-28T10:00:00Z", event_name="purchase", product_id="P",
                  order=dict(order_id="O", total=2.0), customer=dict(is_member=True), quantity=2)
    row = parsing.events_from_v2(messages(spark, nested)).first()
    assert (row.order.order_id, row.order.status, row.customer.is_member, row.quantity) == ("O", None, True, 2)


@pytest.mark.parametrize("message, reasons", [
    (VIEW, []), (BUY, []), ("{", ["unparsable"]), (None, ["unparsable"]),
    ({**VIEW, "event_time": "x"}, ["bad_time"]),
    ({**VIEW, "event_name": None}, ["null_event_name"]),
    ({**VIEW, "event_name": "wish"}, ["unknown_event_name"]),
    ({**VIEW, "price": None, "user_id": None}, ["missing:user_id", "missing:price"]),
    ({**BUY, "items": None}, ["missing:items"]),
    ({**VIEW, "event_name": "begin_checkout"}, ["missing:checkout_id", "missing:cart_items_qty", "missing:cart_value"])])
def test_contract(spark, message, reasons):
    checked = quality.checked_messages(messages(spark, message))
    assert checked.first().reasons == reasons
    assert quality.valid_messages(checked).count() == (0 if reasons else 1)
    assert quality.quarantined(checked).count() == (1 if reasons else 0)


def test_text_is_parsed_once(spark):
    table = quality.quarantined(quality.checked_messages(messages(spark, VIEW)))
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_order_lines(spark):
    parsed = parsing.events_from_v1(messages(spark, BUY, VIEW))
    lines = commerce.order_lines(parsed)
    assert [(r.product_id, r.line_total) for r in lines.orderBy("line").collect()] == [("SKU1", 5.0), ("SKU2", 3.3)]
    sales = {r.product_id: (r.orders, r.units, r.revenue) for r in commerce.product_sales(lines).collect()}
    assert sales == {"SKU1": (1, 2, 5.0), "SKU2": (1, 3, 3.3)}
    catalog = {r.product_id: r for r in commerce.product_catalog(parsed, lines).collect()}
    assert (catalog["SKU1"].name, catalog["SKU1"].price, catalog["SKU2"].category) == ("Ñandú", 2.5, "Ropa")


def test_reconciliation(spark):
    bare = [{k: v for k, v in item.items() if k != "price"} for item in BUY["items"]]
    off = [{**BUY, "event_id": "3", "revenue": 8.31}, {**BUY, "event_id": "4", "cart_items_qty": 4},
           {**BUY, "event_id": "5", "cart_value": 1.0}, {**BUY, "event_id": "6", "items": None},
           {**BUY, "event_id": "7", "cart_value": None}, {**BUY, "event_id": "8", "items": bare}]
    parsed = parsing.events_from_v1(messages(spark, BUY, VIEW, *off))
    found = {r.event_id: r.differing for r in quality.order_reconciliation(parsed).collect()}
    assert found == {
        "3": ["revenue"], "4": ["cart_items_qty"], "5": ["cart_value"], "6": ["missing:items"],
        "7": ["missing:cart_value"], "8": ["missing:item_values"]}


def test_line_totals(spark):
    wrong = {**BUY, "event_id": "9", "items": [{**BUY["items"][0], "line_total": 1.0}, {**BUY["items"][1], "line_total": None}]}
    lines = commerce.order_lines(parsing.events_from_v1(messages(spark, BUY, wrong)))
    found = commerce.line_total_mismatches(lines).filter("event_id = '9'")
    assert sorted(r.line for r in found.collect()) == [0, 1]


def test_position_and_repeats(spark):
    sent = messages(spark, VIEW, VIEW).withColumn("partition", F.lit(0)).withColumn("offset", F.monotonically_increasing_id())
    events = parsing.events_from_v1(sent)
    assert events.filter("source_offset is not null and source_partition = 0").count() == 2
    kept = parsing.first_per_event(events).collect()
    assert len(kept) == 1 and kept[0].source_offset == events.agg(F.min("source_offset")).first()[0]


def test_numbers_that_are_none(spark):
    text = json.dumps(VIEW).replace(json.dumps(VIEW["price"]), "NaN") if VIEW.get("price") else "{}"
    rows = spark.createDataFrame([(text,)], "value string")
    assert parsing.events_from_v1(rows).filter(F.isnan("price")).count() == 0
