import pytest

from clickloom.operators import snapshot
from clickloom.plans import pages
from clickloom.sources import snapshots

SCHEMA = "product_id string, event_name string, count long"


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def small(spark):
    return counts(spark, ("A", "product_view", 5), ("A", "add_to_cart", 2), ("B", "product_view", 3),
                  ("B", "purchase", 1), (None, "click", 4), ("C", None, 2))


def test_by_event_and_product(small):
    events = {r.event_name: r for r in snapshot.by_event(small).collect()}
    assert set(events) == {"product_view", "add_to_cart", "purchase", "click"}
    assert (events["product_view"]["count"], events["product_view"].active_products) == (8, 2)
    assert events["click"].avg_per_active_product == 0.0
    products = snapshot.by_product(small).collect()
    assert [(r.product_id, r["count"], r.event_types) for r in products] == [("A", 7, 2), ("B", 4, 2), ("C", 2, 0)]
    assert sum(r.share for r in products) == pytest.approx(1.0)


def test_kpis(small):
    row = snapshot.kpis(small).first()
    assert (row.total_interactions, row.active_products, row.event_types) == (17, 3, 4)
    assert row.avg_per_product == 5
    assert row.top_product_share == 7 / 13
    assert row.view_to_cart == 0.25 and row.cart_to_checkout == 0.0
    assert row.purchase_share == 1 / 17


def test_empty(spark):
    empty = counts(spark)
    assert set(snapshot.kpis(empty).first()) == {0}
    assert [r["count"] for r in snapshot.funnel(empty).collect()] == [0] * 8
    assert set(snapshot.funnel_ratios(empty).first()) == {0.0}
    for build in (snapshot.by_event, snapshot.by_product, snapshot.mix_matrix,
                  snapshot.purchases_by_product, pages.pareto_of_events, pages.busiest_product_page):
        assert build(empty).count() == 0


def test_drilldown(small):
    mix = snapshot.drilldown(small, "A")
    assert [(r.event_name, r["count"]) for r in mix.collect()] == [("product_view", 5), ("add_to_cart", 2)]
    assert tuple(snapshot.drilldown_totals(mix).first()) == (7, 2, 0.0)
    assert [r.product_id for r in snapshot.drilldown_candidates(small, 2).collect()] == ["A", "B"]


def test_hashes(spark):
    stats = counts(spark, ("A", "click", 1), ("A", "purchase", 2), ("x:B", "click", 3))
    hashes = snapshots.to_hashes(stats)
    assert {r.key: r.stats for r in hashes.collect()} == {
        "realtime:stats:A": {"click": 1, "purchase": 2}, "realtime:stats:x:B": {"click": 3}}
    back = {tuple(r) for r in snapshots.from_hashes(hashes).collect()}
    assert back == {("A", "click", 1), ("A", "purchase", 2), ("B", "click", 3)}


def test_bad_counts_are_dropped(spark):
    raw = spark.createDataFrame([("A", "click", "7"), ("A", "buy", "many")],
                                "product_id string, event_name string, count string")
    assert [tuple(r) for r in snapshots.clean_counts(raw).collect()] == [("A", "click", 7)]
