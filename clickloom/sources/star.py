"""The clickstream as it can be read out of the star-schema test tables.

The tables hold no clickstream of their own; this view maps them onto the event table's columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import (
    CUSTOMER,
    DEVICE,
    EVENT_V2,
    GEO,
    MARKETING,
    ORDER,
    PRODUCT,
)
from clickloom.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_name() -> Column:
    big = F.col("value") >= 60
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "product_view")
        .when((kind == "click") & big, "add_to_cart")
        .when(kind == "click", "click")
        .when((kind == "signup") & big, "checkout_progress")
        .when(kind == "signup", "begin_checkout")
        .when((kind == "error") & big, "remove_from_cart")
        .when(kind == "error", "update_cart")
        .when(kind == "purchase", "purchase")
    )


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row per row of ``events``; no join."""
    return flat_events(table(pin_utc(spark), sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base_events`` as a stream. The pattern lets the table be one file or a folder of files."""
    schema = table(pin_utc(spark), sf_dir, "events").schema
    return flat_events(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet"))


def flat_events(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    named = raw.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id").alias("uid"),
        "value",
        k.alias("k"),
        _event_name().alias("event_name"),
    )
    even = F.col("seq") % 2 == 0
    product_less = F.col("event_name").isin("begin_checkout", "checkout_progress", "purchase") & even
    sku = F.concat(F.lit("SKU"), F.lpad((F.col("k") + 1).cast("string"), 5, "0"))
    return named.select(
        "*",
        F.col("seq").cast("string").alias("event_id"),
        F.col("uid").cast("string").alias("user_id"),
        F.concat_ws("-", "uid", F.to_date("event_time")).alias("session_id"),
        sku.alias("sku"),
        F.when(~product_less, sku).alias("product_id"),
        F.when(F.col("seq") % 3 != 0, 1 + F.col("k") % 5).cast("int").alias("quantity"),
        F.when(F.col("seq") % 4 != 0, F.col("value")).alias("price"),
        F.when(F.col("value") >= 10, F.col("value")).alias("revenue"),
        F.when(F.col("seq") % 13 != 0, F.when(even, "web").otherwise("app")).alias("event_source"),
    )


def _product_struct(part: DataFrame | None) -> Column:
    if part is None:
        return F.lit(None).cast(PRODUCT)
    return F.struct(
        F.col("sku").alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"),
        F.lit(None).cast("int").alias("quantity"),
    )


def _order_struct(orders: DataFrame | None) -> Column:
    if orders is None:
        return F.lit(None).cast(ORDER)
    provider = F.when(
        F.col("o_orderkey").isNotNull() & (F.col("seq") % 2 == 0),
        F.concat(F.lit("P"), (F.col("k") % 3).cast("string")),
    )
    return F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"), provider.alias("payment_provider"),
        F.col("o_totalprice").alias("total"),
    )


def _customer_struct(customer: DataFrame | None) -> Column:
    if customer is None:
        return F.lit(None).cast(CUSTOMER)
    known = F.col("uid") % 9 != 0
    tier = (F.when(F.col("c_acctbal") < 0, "bronze").when(F.col("c_acctbal") < 5000, "silver")
            .when(F.col("c_acctbal").isNotNull(), "gold"))
    return F.struct(
        F.when(known, F.col("c_custkey").cast("string")).alias("customer_id"),
        F.when(known, F.col("c_mktsegment")).alias("segment"),
        F.when(known, tier).alias("loyalty_tier"),
        F.when(F.col("uid") % 7 != 0, F.col("c_acctbal") > 0).alias("is_member"),
    )


def _geo_struct(nation: DataFrame | None) -> Column:
    if nation is None:
        return F.lit(None).cast(GEO)
    city = F.when(F.col("uid") % 5 != 0, F.concat(F.lit("City"), (F.col("uid") % 20).cast("string")))
    return F.struct(F.col("n_name").alias("country"), city.alias("city"))


def _numbered(prefix: str, modulus: int, null_every: int) -> Column:
    text = F.concat(F.lit(prefix), (F.col("uid") % modulus).cast("string"))
    return F.when(F.col("uid") % null_every != 0, text)


def clickstream(spark: SparkSession, sf_dir: str, *needs: str) -> DataFrame:
    """The event table. ``needs`` names the structs a query reads among product, order, customer
    and geo; the others stay null and cost no join.

    Join keys stay spread out (never a null key for rows without a match), and no side is forced
    to broadcast: Spark does that itself where the size allows, and splits hot keys otherwise.
    """
    rows = base_events(spark, sf_dir)
    part = orders = customer = nation = None
    if "product" in needs:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
        rows = rows.join(part, F.col("p_partkey") == F.col("k") + 1, "left")
    if "order" in needs:
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
        rows = rows.join(
            orders, (F.col("o_orderkey") == F.col("seq")) & (F.col("event_name") == "purchase"), "left")
    if "customer" in needs or "geo" in needs:
        customer = table(spark, sf_dir, "customer").select(
            "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        if "geo" in needs:
            nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
            customer = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        rows = rows.join(customer, F.col("c_custkey") == F.col("uid"), "left")
    marketing = F.struct(
        _numbered("ch", 4, 10).alias("channel"), _numbered("src", 5, 10).alias("source"),
        _numbered("med", 3, 10).alias("medium"), _numbered("camp", 6, 10).alias("campaign_name"),
    ).cast(MARKETING)
    kind = F.col("uid") % 3
    device_type = F.when(
        F.col("uid") % 11 != 0,
        F.when(kind == 0, "mobile").when(kind == 1, "desktop").otherwise("tablet"))
    device = F.struct(device_type.alias("device_type"), _numbered("os", 4, 11).alias("os")).cast(DEVICE)
    return rows.select(
        "event_id", "event_time", "event_name", "user_id", "session_id", "product_id", "revenue",
        "quantity", "price", "event_source", marketing.alias("marketing"),
        _customer_struct(customer if "customer" in needs else None).alias("customer"),
        _geo_struct(nation).alias("geo"),
        _product_struct(part).alias("product"), device.alias("device"),
        _order_struct(orders).alias("order"),
    )


def cart_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a cart log: one cart per user, five products with fixed prices."""
    slot = F.col("k") % 5
    touches = F.col("event_name").isin("add_to_cart", "update_cart", "remove_from_cart")
    return base_events(spark, sf_dir).select(
        F.concat(F.lit("C"), "user_id").alias("cart_id"),
        "session_id", "user_id", "event_time",
        F.concat(F.lit("E"), F.lpad("event_id", 18, "0")).alias("event_id"), "event_name",
        F.when(touches, F.concat(F.lit("SKU"), F.lpad((slot + 1).cast("string"), 5, "0"))).alias("product_id"),
        F.when(touches, 1 + F.col("seq") % 4).cast("int").alias("quantity"),
        F.when(touches, 10.0 + 2.25 * slot).alias("price"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One purchase per row of ``lineitem``, of one to three items.

    Every sixth line number records a wrong total of its first item. The first item is the line's part, the others its successors in the catalogue. Every fifth
    ship day records a revenue that is off, every seventh line number a wrong quantity.
    """
    line = table(pin_utc(spark), sf_dir, "lineitem").withColumns({
        "at": F.col("l_shipdate").cast("timestamp"), "n": F.col("l_linenumber") % 3 + 1})

    wrong_total = F.when(F.col("l_linenumber") % 6 == 0, 0.5).otherwise(0.0)

    def price(i: int) -> Column:
        return F.lit(5.0) + (F.col("l_partkey") + i) % 400 * 0.25

    def quantity(i: int) -> Column:
        return F.col("l_quantity").cast("int") + i

    def item(i: int) -> Column:
        part = (F.col("l_partkey") + i).cast("string")
        return F.struct(
            F.concat(F.lit("SKU"), part).alias("product_id"),
            F.concat(F.lit("Producto "), part).alias("name"),
            F.concat(F.lit("Cat"), ((F.col("l_partkey") + i) % 7).cast("string")).alias("category"),
            price(i).alias("price"), quantity(i).alias("quantity"),
            (price(i) * quantity(i) + (wrong_total if i == 0 else F.lit(0.0))).alias("line_total"))

    def over_items(value: Callable[[int], Column]) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.col("n") > i, value(i)).otherwise(0) for i in range(3)])

    worth = over_items(lambda i: price(i) * quantity(i))
    order = F.struct(
        F.col("l_orderkey").cast("string").alias("order_id"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("payment_method"), F.lit(None).cast("string").alias("payment_provider"),
        worth.alias("total"))
    rows = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        order.alias("order"), F.col("at").alias("event_time"), F.to_date("at").alias("event_date"),
        F.lit("purchase").alias("event_name"),
        (worth + F.when(F.dayofmonth("at") % 5 == 0, 1.0).otherwise(0.0)).alias("revenue"),
        worth.alias("cart_value"),
        (over_items(quantity) + F.when(F.col("l_linenumber") % 7 == 0, 1).otherwise(0)).alias("cart_items_qty"),
        # Generated, so that it behaves like a stored column: filters that Spark derives from a
        # later explode would build the array again.
        F.explode(F.array(F.slice(F.array(*[item(i) for i in range(3)]), 1, F.col("n")))).alias("items"),
    )
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_V2])


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as flat JSON messages, some of them broken in known ways (by event number)."""
    e = base_events(spark, sf_dir)
    return e.select("seq", message_of(e).alias("value"))


def message_of(events: DataFrame) -> Column:
    """JSON text of a row of ``base_events``; also usable on a stream."""
    seq = F.col("seq")
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    item = F.struct(
        F.col("sku").alias("product_id"), F.lit("Producto").alias("name"),
        F.lit("Hogar").alias("category"), F.col("price"), F.col("quantity"),
        F.col("price").alias("line_total"))
    fields = {
        "event_id": F.col("event_id"),
        "event_time": F.when(seq % 29 == 0, "garbage").otherwise(stamp),
        "event_name": F.when(seq % 31 == 0, None).when(seq % 37 == 0, "wishlist").otherwise(
            F.col("event_name")),
        "user_id": F.col("user_id"),
        "session_id": F.col("session_id"),
        "device": F.lit("mobile"),
        "currency": F.lit("USD"),
        "product_id": F.col("product_id"),
        "quantity": F.col("quantity"),
        "price": F.col("price"),
        "cart_id": F.concat(F.lit("C"), "user_id"),
        "cart_items_qty": F.when(seq % 41 != 0, 1),
        "cart_value": F.lit(1.5),
        "checkout_id": F.when(seq % 43 != 0, F.concat(F.lit("K"), "event_id")),
        "order_id": F.when(seq % 47 != 0, F.concat(F.lit("O"), "event_id")),
        "revenue": F.col("revenue"),
        "page_url": F.lit("https://example.com/"),
        "referrer": F.lit("https://example.com/"),
        "items": F.when((F.col("event_name") == "purchase") & (seq % 5 != 0), F.array(item)),
    }
    text = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return F.when(seq % 23 == 0, F.substring(text, 1, 25)).otherwise(text)
