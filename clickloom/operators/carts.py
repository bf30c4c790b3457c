"""Cart replay: what each cart held after every event, recomputed from the events.

The rows are laid out in ranges of carts and times of about equal size (``operators.scans``), and within a range the
replay is a handful of windows. A cart that spans several ranges starts each of them with opening rows that say
what it held by then; those come from a first pass over such carts' rows that leaves one row per cart, range and
product. Worth is counted in decimals, so no result depends on where a range ends. Where the rows are on disk already
(``carried_replay``), only busy carts are laid out; the others are one range each as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.measures import is_event, is_purchase
from clickloom.operators.scans import CHUNK, crossing, laid_out
from clickloom.session import settle

MONEY = "decimal(38,6)"


def nothing() -> Column:
    return F.lit(0).cast(MONEY)


def default_order(events: DataFrame) -> list[str]:
    """By time, then by the place on the topic where the table has it (event times are whole seconds), then by id."""
    place = [c for c in ("source_partition", "source_offset") if c in events.columns]
    return ["event_time", *place, "event_id"]


# The events that show cart totals.
CART_EVENTS = ("add_to_cart", "update_cart", "remove_from_cart", "begin_checkout",
               "checkout_progress", "purchase")

GROUP = ["cart_id", CHUNK]

#: A cart of more rows than this is busy.
BUSY = 100_000


def cart_replay(events: DataFrame, order: list[str] | None = None,
                ranges: int | None = None) -> DataFrame:
    """Cart events with ``replayed_qty`` and ``replayed_value``.

    Adding increases a product's quantity, updating sets it, removing drops the product, and a
    purchase shows the cart as it was and then empties it. ``order`` must order a cart's events
    completely; by default that is the time, the place on the topic if known, and the id. Views, clicks and
    events without a cart show no totals and are left out.
    """
    found = _replayed(_cart_rows(events), order or default_order(events), ranges)
    return found.select(*events.columns, "replayed_qty", "replayed_value")


def held_before(events: DataFrame, order: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Cart events with ``held_qty``, what the cart held of the event's product before it; 0 without a product."""
    found = _replayed(_cart_rows(events), order or default_order(events), ranges)
    held = F.when(F.col("__product").isNotNull(), F.col("__q") - F.col("__dq")).otherwise(0)
    return found.select(*events.columns, held.cast("bigint").alias("held_qty"))


def carried_replay(events: DataFrame, held: DataFrame, order: list[str] | None = None,
                   ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``cart_replay`` of carts that held something before, and what these carts hold afterwards.

    Both contents are ``cart_id, product_id, quantity, worth``. A cart of ``events`` that ends empty has one row
    without a product; carts without events are left out. With an ``order``, which must be complete, the totals are
    settled and the contents are read off them; the default order may leave ties.
    The totals have ``__tail`` besides, true for the last event of a cart and for the last of each range of a busy one.
    """
    complete = order is not None
    order = ["__later", *(order or default_order(events))]
    fresh = settle(_cart_rows(events).withColumn("__later", F.lit(True)), "cart_rows")
    touched = fresh.select("cart_id").distinct()
    opening = settle(held.filter(F.col("product_id").isNotNull()).join(touched, "cart_id", "left_semi").select(
        "cart_id", F.col("product_id").alias("__product"), F.col("quantity").alias("__own"),
        F.col("worth").cast(MONEY).alias("__worth"), F.lit(0).alias("__reset"), F.lit(0).alias("__bought"),
        F.lit(False).alias("__later")), "held")
    rows = fresh.unionByName(opening, allowMissingColumns=True)
    found = _replayed(rows, order, ranges) if ranges else _replayed_apart(rows, order)
    shown = [*events.columns, "replayed_qty", "replayed_value", "__tail"]
    if not complete:
        return found.filter("__later").select(*shown), touched.join(_contents(rows, order), "cart_id", "left")
    held_at_end = [F.when(F.col("__end"), F.col(c)).alias(c) for c in ("__product", "__q", "__w")]
    found = settle(found.filter("__later or __tail or __end").select(
        *shown, *held_at_end, "__end", "__later", "__purchases", CHUNK), "totals")
    return found.filter("__later").select(*shown), _contents_at_end(found)


def _contents_at_end(found: DataFrame) -> DataFrame:
    """What each cart holds at the end, from its replayed rows: of each product the last row in the last range that has one, if
    no range after it empties the cart."""
    carts = found.filter("__tail").groupBy("cart_id").agg(F.max(F.when(F.col("__purchases") > 0, F.col(CHUNK))).alias("__emptied"))
    products = found.filter("__end").join(carts, "cart_id").filter(F.col("__emptied").isNull() | (F.col(CHUNK) >= F.col("__emptied")))
    last = products.groupBy("cart_id", F.col("__product").alias("product_id")).agg(
        F.max_by("__q", CHUNK).alias("quantity"), F.max_by("__w", CHUNK).alias("worth"))
    return carts.select("cart_id").join(last.filter("quantity != 0 or worth != 0"), "cart_id", "left")


def _contents(rows: DataFrame, order: list[str]) -> DataFrame:
    """What each cart holds at the end: a product's rows since its last reset, after the cart's last purchase."""
    at = F.struct(*order)
    emptied = rows.filter("__bought = 1").groupBy("cart_id").agg(F.max(at).alias("__emptied"))
    live = rows.filter(F.col("__product").isNotNull()).join(emptied, "cart_id", "left").filter(
        F.col("__emptied").isNull() | (at > F.col("__emptied")))
    resets = live.filter("__reset = 1").groupBy("cart_id", "__product").agg(F.max(at).alias("__from"))
    return (
        live.join(resets, ["cart_id", "__product"], "left")
        .filter(F.col("__from").isNull() | (at >= F.col("__from")))
        .groupBy("cart_id", F.col("__product").alias("product_id"))
        .agg(F.sum("__own").alias("quantity"), F.sum("__worth").cast(MONEY).alias("worth"))
        .filter("quantity != 0 or worth != 0")
    )


def _replayed(rows: DataFrame, order: list[str], ranges: int | None) -> DataFrame:
    """Rows of ``_cart_rows`` with their totals."""
    rows = laid_out(rows, "cart_id", order, ranges)
    narrow = rows.join(crossing(rows, "cart_id"), "cart_id", "left_semi").select(
        *GROUP, *order, "__product", "__reset", "__own", "__worth", "__bought")
    openings = _openings(narrow, order).withColumn("__opening", F.lit(True))
    opened = rows.withColumn("__opening", F.lit(False)).unionByName(openings, allowMissingColumns=True)
    # Opening rows come first.
    return _scanned(opened, [F.desc("__opening"), *order]).filter(~F.col("__opening")).drop("__opening")


def _replayed_apart(rows: DataFrame, order: list[str]) -> DataFrame:
    """``_replayed`` of rows that are cheap to read again: only busy carts are laid out."""
    busy = settle(rows.groupBy("cart_id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > BUSY).select("cart_id"), "busy")
    if busy.isEmpty():
        return _scanned(rows.withColumn(CHUNK, F.lit(0)), order)
    others = _scanned(rows.join(busy, "cart_id", "left_anti").withColumn(CHUNK, F.lit(0)), order)
    return others.unionByName(_replayed(rows.join(busy, "cart_id", "left_semi"), order, None))


def _scanned(opened: DataFrame, order: list) -> DataFrame:
    """Rows with their totals, range by range. ``__tail`` marks the last row of a range, ``__end`` the last of a product that
    the range does not empty the cart after; ``__purchases`` are those in the range."""
    piece = Window.partitionBy(*GROUP).orderBy(*order)
    whole = piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    product = Window.partitionBy(*GROUP, "__epoch", "__product").orderBy(*order)
    so_far = (
        Window.partitionBy(*GROUP, "__epoch").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    marked = opened.withColumns({
        "__tail": F.lead(F.lit(1)).over(piece).isNull(), "__purchases": F.sum("__bought").over(whole)})
    last = F.lead(F.lit(1)).over(product).isNull()
    ends = _changes(marked, order).withColumn(
        "__end", F.col("__product").isNotNull() & (F.col("__epoch") == F.col("__purchases")) & last)
    totals = ends.withColumns({
        "replayed_qty": F.sum("__dq").over(so_far), "__value": F.sum("__dw").over(so_far)})
    return totals.withColumn("replayed_value", F.bround("__value", 2).cast("double"))


def _cart_rows(events: DataFrame) -> DataFrame:
    reset = is_event("update_cart") | is_event("remove_from_cart")
    touch = F.col("product_id").isNotNull() & (is_event("add_to_cart") | reset)
    # What the event itself leaves of the product: a removal leaves nothing.
    own = F.when(touch & ~is_event("remove_from_cart"), F.col("quantity"))
    shown = events.filter(F.col("cart_id").isNotNull() & F.col("event_name").isin(*CART_EVENTS))
    return shown.withColumns({
        "__product": F.when(touch, F.col("product_id")),
        "__reset": (touch & reset).cast("int"),
        "__own": F.coalesce(own, F.lit(0)).cast("bigint"),
        "__worth": F.coalesce((own.cast("bigint") * F.col("price").try_cast("decimal(19,6)")).cast(MONEY), nothing()),
        "__bought": is_purchase().cast("int"),
    })


def _changes(rows: DataFrame, order: list) -> DataFrame:
    """Per row and group: ``__epoch``, the purchases before it, and its change of the cart's
    quantity and worth. A product's holdings add up from its last reset on: they are its sum so far, less
    what that was before the reset, so that both come out of one sort."""
    def window(*keys: str):
        return Window.partitionBy(*GROUP, *keys).orderBy(*order)

    def up_to(spec, end: int):
        return spec.rowsBetween(Window.unboundedPreceding, end)

    product = window("__epoch", "__product")

    def since_reset(total: str, own: str) -> Column:
        before = F.last(F.when(F.col("__reset") == 1, F.col(total) - F.col(own)), True).over(up_to(product, 0))
        return F.col(total) - F.coalesce(before, F.lit(0))

    def change(held: str) -> Column:
        return (F.col(held) - F.coalesce(F.lag(held).over(product), F.lit(0))).cast(
            "bigint" if held == "__q" else MONEY)

    return (
        rows.withColumn("__epoch", F.coalesce(F.sum("__bought").over(up_to(window(), -1)), F.lit(0)))
        .withColumns({"__sq": F.sum("__own").over(up_to(product, 0)), "__sw": F.sum("__worth").over(up_to(product, 0))})
        .withColumns({"__q": since_reset("__sq", "__own"), "__w": since_reset("__sw", "__worth").cast(MONEY)})
        .withColumns({"__dq": change("__q"), "__dw": change("__w")})
    )


def _openings(rows: DataFrame, order: list[str]) -> DataFrame:
    """What a cart holds as each of its ranges starts: a row per product the range touches
    before its first purchase, and one for the rest of the cart."""
    purchases = F.sum("__bought").over(Window.partitionBy(*GROUP))
    at_end = F.col("__epoch") == F.col("__purchases")
    ends = (
        # Each product's part of the cart as the chunk ends, as if it had started empty.
        _changes(rows, order).withColumn("__purchases", purchases)
        .groupBy(*GROUP, "__product", (F.col("__purchases") > 0).alias("__emptied"))
        .agg(
            F.max(F.col("__epoch") == 0).alias("__first"),
            F.max(at_end).alias("__last"),
            F.max(F.when(at_end, F.col("__reset"))).alias("__reset"),
            F.coalesce(F.sum(F.when(at_end, F.col("__dq"))), F.lit(0)).alias("__q"),
            F.coalesce(F.sum(F.when(at_end, F.col("__dw"))), nothing()).cast(MONEY).alias("__w"),
        )
    )
    # Chunks that empty the cart cut its history; number the pieces on one row per chunk.
    earlier = Window.partitionBy("cart_id").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(*GROUP).agg(F.max("__bought").alias("__bought")).select(
        *GROUP, F.coalesce(F.sum("__bought").over(earlier), F.lit(0)).alias("__piece"))

    # Two entries per product and chunk: the question what it held before (0), then its change (1).
    fresh = F.col("__emptied")
    question = F.struct(
        F.col("__piece").alias("__piece"), F.lit(0).alias("__kind"), F.lit(0).alias("__cut"),
        F.lit(0).cast("bigint").alias("__q"), nothing().alias("__w"))
    answer = F.struct(
        (F.col("__piece") + fresh.cast("int")).alias("__piece"), F.lit(1).alias("__kind"),
        (fresh | (F.col("__reset") == 1)).cast("int").alias("__cut"), "__q", "__w")
    entries = F.array_compact(F.array(F.when(F.col("__first"), question), F.when(F.col("__last"), answer)))
    timeline = ends.join(pieces, GROUP).select(*GROUP, "__product", F.inline(entries))

    product = Window.partitionBy("cart_id", "__product", "__piece").orderBy(CHUNK, "__kind")
    held = (
        Window.partitionBy("cart_id", "__product", "__piece", "__section").orderBy(CHUNK, "__kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def change(name: str) -> Column:
        return (F.col(name) - F.coalesce(F.lag(name).over(product), F.lit(0))).cast(
            "bigint" if name == "__hq" else MONEY)

    states = (
        timeline.withColumn("__section", F.sum("__cut").over(
            product.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumns({"__hq": F.sum("__q").over(held), "__hw": F.sum("__w").over(held)})
        .withColumns({"__dq": change("__hq"), "__dw": change("__hw")})
    )
    asked = F.col("__kind") == 0
    per_product = states.filter(asked & F.col("__product").isNotNull()).select(
        *GROUP, "__product", F.col("__hq").alias("__own"), F.col("__hw").alias("__worth"))

    # The whole cart at a chunk's start, less the products that have a row of their own.
    whole = (
        Window.partitionBy("cart_id", "__piece").orderBy(CHUNK, "__kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_chunk = states.groupBy(*GROUP, "__piece", "__kind").agg(
        F.sum(F.when(asked, F.col("__hq")).otherwise(0)).alias("__asked_q"),
        F.sum(F.when(asked, F.col("__hw")).otherwise(nothing())).cast(MONEY).alias("__asked_w"),
        F.sum(F.when(asked, 0).otherwise(F.col("__dq"))).alias("__dq"),
        F.sum(F.when(asked, nothing()).otherwise(F.col("__dw"))).cast(MONEY).alias("__dw"),
    )
    rest = (
        per_chunk.withColumns({"__tq": F.sum("__dq").over(whole), "__tw": F.sum("__dw").over(whole)})
        .filter(asked)
        .select(*GROUP, F.lit(None).cast("string").alias("__product"),
                (F.col("__tq") - F.col("__asked_q")).alias("__own"),
                (F.col("__tw") - F.col("__asked_w")).cast(MONEY).alias("__worth"))
    )
    return (
        per_product.unionByName(rest)
        .filter((F.col("__own") != 0) | (F.col("__worth") != 0))
        .withColumns({"__reset": F.lit(0), "__bought": F.lit(0)})
    )


def cart_mismatches(replayed: DataFrame) -> DataFrame:
    """Cart events whose recorded totals differ from the replay or are missing."""
    same_value = F.abs(F.col("cart_value") - F.col("replayed_value")) < 0.005
    same = F.col("cart_items_qty").eqNullSafe(F.col("replayed_qty")) & F.coalesce(same_value, F.lit(False))
    return replayed.filter(~same)
