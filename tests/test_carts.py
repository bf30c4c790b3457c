"""Cart replay and session rules against a plain fold over the events."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.operators import carts, quality, scans
from clickloom.session import shared_dir
from clickloom.streaming.carts import contents_before, read_totals, replay_batches, start_cart_replay

SCHEMA = ("cart_id string, session_id string, event_time timestamp, event_id string, event_name string, "
          "product_id string, quantity int, price double, cart_items_qty int, cart_value double")
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
NAMES = ("add_to_cart", "add_to_cart", "update_cart", "remove_from_cart", "begin_checkout",
         "checkout_progress", "purchase", "product_view")


def fold(events):
    """Reference result by a straightforward loop: totals and broken rules per event id."""
    carts_, open_, totals, broken = {}, {}, {}, {}
    for e in sorted(events, key=lambda e: (e[2], e[3])):
        cart_id, session, _, event_id, name, product, quantity, price = e[:8]
        cart = carts_.setdefault(cart_id, {})
        if name == "add_to_cart":
            cart[product] = cart.get(product, 0) + quantity
        elif name == "update_cart":
            cart[product] = quantity
        elif name == "remove_from_cart":
            cart.pop(product, None)
        if name in carts.CART_EVENTS:
            totals[event_id] = (sum(cart.values()), round(sum(q * price_of(p) for p, q in cart.items()), 2))
        reasons = []
        if name == "begin_checkout" and open_.get(session):
            reasons.append("checkout_already_open")
        if name in ("checkout_progress", "purchase") and not open_.get(session):
            reasons.append("no_open_checkout")
        if name in ("begin_checkout", "purchase") and not cart:
            reasons.append("empty_cart")
        if reasons:
            broken[event_id] = reasons
        if name == "begin_checkout":
            open_[session] = True
        if name == "purchase":
            open_[session] = False
            cart.clear()
    return totals, broken


def price_of(product):
    return 1.25 + 3.1 * int(product[1:])


def history(n, seed, carts_=4, products=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        name = rng.choice(NAMES)
        touch = name in ("add_to_cart", "update_cart", "remove_from_cart")
        product = f"P{rng.randrange(products)}" if touch else None
        cart = min(rng.randrange(carts_), rng.randrange(carts_))
        rows.append((f"C{cart}", f"S{cart}", START + timedelta(seconds=rng.randrange(40_000)), f"E{i:05d}", name,
                     product, rng.randint(1, 5) if touch else None, price_of(product) if touch else None, None, None))
    return rows


@pytest.mark.parametrize("ranges", [None, 1, 2, 7, 60])
def test_replay_equals_fold(spark, ranges):
    rows = history(1500, seed=ranges or 0)
    expected, _ = fold(rows)
    events = spark.createDataFrame(rows, SCHEMA)
    found = carts.cart_replay(events, ranges=ranges).collect()
    assert {r.event_id: (r.replayed_qty, r.replayed_value) for r in found} == expected
    assert len(found) == len(expected)


def test_ranges_do_not_change_cents(spark):
    """Prices of three decimals, one cart, all in one second or without a time."""
    rng = random.Random(1)
    rows = [("C", "S", None if i % 50 == 0 else START, f"E{i:05d}", rng.choice(NAMES[:4]), f"P{rng.randrange(40)}",
             rng.randint(1, 5), rng.randrange(1000, 99999) / 1000, None, None) for i in range(2000)]
    events = spark.createDataFrame(rows, SCHEMA)
    found = [{r.event_id: (r.replayed_qty, r.replayed_value) for r in carts.cart_replay(events, ranges=n).collect()}
             for n in (1, 9, 40)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 2000


def test_repeated_steps_do_not_multiply(spark):
    row = ("C", "S", START, "1", "checkout_progress", None, None, None, None, None)
    assert quality.session_violations(spark.createDataFrame([row, row], SCHEMA)).count() == 2


@pytest.mark.parametrize("ranges", [1, 12])
def test_session_rules_equal_fold(spark, ranges):
    rows = history(800, seed=5)
    _, expected = fold(rows)
    found = quality.session_violations(
        spark.createDataFrame(rows, SCHEMA), ranges=ranges).collect()
    assert {r.event_id: r.reasons for r in found} == expected


def test_recorded_totals(spark):
    def at(i, name, product, quantity, qty, value):
        price = price_of(product) if product else None
        return ("C", "S", START + timedelta(minutes=i), str(i), name, product, quantity, price, qty, value)

    rows = [
        at(1, "add_to_cart", "P1", 2, 2, 8.7), at(2, "update_cart", "P1", 5, 5, 21.75),
        at(3, "add_to_cart", "P0", 1, 6, 23.0), at(4, "remove_from_cart", "P1", 5, 1, 1.25),
        at(5, "purchase", None, None, 1, 1.25), at(6, "add_to_cart", "P0", 1, 2, 1.25),
        at(7, "add_to_cart", "P0", 1, None, None),
    ]
    replayed = carts.cart_replay(spark.createDataFrame(rows, SCHEMA))
    assert [r.event_id for r in carts.cart_mismatches(replayed).orderBy("event_id").collect()] == ["6", "7"]


def test_last_before(spark):
    rows = [("k", START + timedelta(hours=h), h, v) for h, v in enumerate([None, 5, None, None, 7, None])]
    events = spark.createDataFrame(rows, "k string, t timestamp, id int, v int")
    for ranges in (1, 4):
        found = scans.last_before(events, "k", ["t", "id"], "prev", F.col("v"), ranges).orderBy("id")
        assert [r.prev for r in found.collect()] == [None, None, 5, 5, 5, 7]


def test_streaming_replay(spark, tmp_path):
    rows = sorted(history(300, seed=3), key=lambda e: (e[2], e[3]))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    before = set(os.listdir(shared_dir(spark)))
    for part in range(5):
        spark.createDataFrame(rows[part * 60:(part + 1) * 60], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        start_cart_replay(stream, out, str(tmp_path / "cp"), available_now=True, compact_every=2).awaitTermination()
    found = read_totals(spark, out).collect()
    assert {r.event_id: (r.replayed_qty, r.replayed_value) for r in found} == fold(rows)[0]
    # Folders that a base covers go, and so do the tables made on the way.
    assert sorted(p.name for p in (tmp_path / "out" / "base").iterdir()) == ["batch_id=1", "batch_id=3"]
    assert sorted(p.name for p in (tmp_path / "out" / "contents").iterdir()) == ["batch_id=2", "batch_id=3", "batch_id=4"]
    assert set(os.listdir(shared_dir(spark))) == before

    # The last batch once more changes nothing.
    batch = spark.createDataFrame(rows[240:], SCHEMA)
    replay_batches(out, compact_every=2)(batch, 4)
    assert {r.event_id: (r.replayed_qty, r.replayed_value) for r in read_totals(spark, out).collect()} == fold(rows)[0]
    with pytest.raises(ValueError):
        replay_batches(out)(batch, 3)


def test_emptied_carts_leave_the_contents(spark, tmp_path):
    rows = [("A", "S", START, "1", "add_to_cart", "P1", 2, 1.5, None, None),
            ("B", "S", START, "2", "add_to_cart", "P1", 1, 1.5, None, None),
            ("A", "S", START + timedelta(1), "3", "purchase", None, None, None, None, None)]
    write = replay_batches(str(tmp_path), compact_every=2)
    write(spark.createDataFrame(rows[:2], SCHEMA), 0)
    assert contents_before(spark, str(tmp_path), 1).count() == 2
    write(spark.createDataFrame(rows[2:], SCHEMA), 1)
    left = [(r.cart_id, r.product_id, r.quantity) for r in contents_before(spark, str(tmp_path), 2).collect()]
    assert left == [("B", "P1", 1)]
    assert spark.read.parquet(str(tmp_path / "base" / "batch_id=1")).count() == 1


@pytest.mark.parametrize("ranges", [1, 9])
def test_cart_rules(spark, ranges):
    def at(i, name, product, quantity):
        return ("C", "S", START + timedelta(minutes=i), f"{i:02d}", name, product, quantity, 1.0, None, None)

    rows = [at(1, "update_cart", "P1", 2), at(2, "add_to_cart", "P2", 3), at(3, "remove_from_cart", "P2", 3),
            at(4, "remove_from_cart", "P2", 3), at(5, "add_to_cart", "P3", 2), at(6, "remove_from_cart", "P3", 1),
            at(7, "add_to_cart", "P4", 1), at(8, "purchase", None, None), at(9, "update_cart", "P4", 1),
            at(10, "remove_from_cart", None, 1)]
    found = quality.cart_rule_violations(spark.createDataFrame(rows, SCHEMA), ranges=ranges)
    assert {r.event_id: r.reasons for r in found.collect()} == {
        "01": ["not_in_cart"], "04": ["not_in_cart"], "06": ["other_quantity_removed"], "09": ["not_in_cart"],
        "10": ["not_in_cart"]}
