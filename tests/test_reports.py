from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.functions.timerange import day_range
from clickloom.operators import combined, reports, shares
from clickloom.plans import pages
from clickloom.plans.queries import all_queries
from clickloom.schemas import EVENT_V2, FUNNEL_STAGES
from clickloom.sources import star
from clickloom.sources.tables import event_query, register_events

JANUARY = day_range(date(2024, 1, 1), date(2024, 1, 31))


def event(**values):
    row = {name: None for name in EVENT_V2.names}
    row.update({"event_time": datetime(2024, 1, 5, 10, tzinfo=timezone.utc), "event_name": "click"}, **values)
    return row


def table(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in EVENT_V2.names) for r in rows], EVENT_V2).drop("event_date")


def test_empty_period(spark):
    events = table(spark)
    totals = reports.overview(events, JANUARY).first()
    assert totals.total_events == 0 and totals.users == 0
    assert totals.purchase is None and totals.avg_order_value_usd is None
    assert reports.overview_ratios(reports.overview(events, JANUARY)).first().view_to_cart == 0.0
    assert [r["count"] for r in reports.overview_funnel(reports.overview(events, JANUARY)).collect()] == [0] * 8
    assert reports.daily_series(events, JANUARY).count() == 0
    assert tuple(reports.series_totals(reports.daily_series(events, JANUARY)).first()) == (0, 0, 0, 0, 0, 0, 0)


def test_measures_fall_back(spark):
    buy = dict(event_name="purchase", user_id="U")
    events = table(
        spark,
        event(**buy, revenue=10.0, quantity=2, price=3.0, order=("O1", None, None, None, 99.0)),
        event(**buy, order=("O1", None, None, None, 5.0), product=("P", None, None, 4.0, 3)),
        event(**buy),
        event(event_name="click", revenue=1000.0),
    )
    row = reports.event_mix(events, JANUARY).filter("event_name = 'purchase'").first()
    assert (row.events, row.users, row.orders) == (3, 1, 1)
    assert (row.units_sold, row.revenue_usd, row.total_sales_usd) == (2 + 3 + 1, 15.0, 6.0 + 12.0)


def test_unknown_groups(spark):
    events = table(
        spark,
        event(product=("P1", None, "B", None, None), customer=(None, None, None, None)),
        event(product_id="P2", customer=(None, None, None, True)),
        event(customer=(None, None, None, False)),
    )
    assert {r.dimension for r in reports.product_report(events, JANUARY, "product").collect()} == {"P1", "P2"}
    assert {r.dimension for r in reports.product_report(events, JANUARY, "brand").collect()} == {"B"}
    members = {r.dimension: r.events for r in reports.dimension_report(events, JANUARY, "membership").collect()}
    assert members == {"member": 1, "non_member": 2}
    assert reports.dimension_report(events, JANUARY, "order_status").count() == 0


def test_counts_agree(spark, sf_dir):
    events = star.clickstream(spark, sf_dir)
    total = reports.overview(events, JANUARY).first().total_events
    for counts, column in (
            (reports.event_mix(events, JANUARY), "events"),
            (reports.daily_series(events, JANUARY), "total_events"),
            (reports.hour_distribution(events, JANUARY), "cnt"),
            (reports.day_event_counts(events, JANUARY), "cnt"),
            (reports.event_counts(events, JANUARY), "cnt")):
        assert counts.agg(F.sum(column)).first()[0] == total == 1000


def test_one_scan_matches_single_reports(spark, sf_dir):
    events = star.clickstream(spark, sf_dir, "product", "order")
    both = reports.multi_dimension_report(events, JANUARY, ("channel", "os"))
    single = reports.dimension_report(events, JANUARY, "os").select("dimension", "events", "units_sold")
    found = both.filter("dimension_name = 'os'").select("dimension", "events", "units_sold")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in single.collect()}
    with pytest.raises(ValueError):
        reports.multi_dimension_report(events, JANUARY, ("order_status",))


def test_free_sql_equals_report(spark, sf_dir):
    register_events(star.clickstream(spark, sf_dir, "order"))
    sql = event_query(
        spark, "SELECT event_name, COUNT(*) AS cnt FROM ecommerce_events "
               "WHERE event_time >= TIMESTAMP '2024-01-01 00:00:00' AND event_time < :upto GROUP BY event_name",
        {"upto": datetime(2024, 2, 1, tzinfo=timezone.utc)})
    report = reports.event_counts(star.clickstream(spark, sf_dir), JANUARY)
    assert {tuple(r) for r in sql.collect()} == {tuple(r) for r in report.collect()}


def numbers(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v bigint")


def test_shares(spark):
    found = shares.add_share(numbers(spark, ("a", 3), ("b", 1), ("c", None)), "v")
    assert {r.k: r.share for r in found.collect()} == {"a": 0.75, "b": 0.25, "c": 0.0}
    assert [r.share for r in shares.add_share(numbers(spark, ("a", 0)), "v").collect()] == [0.0]
    texts = spark.createDataFrame([("a", "3"), ("b", "x")], "k string, v string")
    assert {r.k: r.share for r in shares.add_share(texts, "v").collect()} == {"a": 1.0, "b": 0.0}
    assert shares.top_share(numbers(spark), "v").first()[0] == 0.0
    assert shares.top_share(numbers(spark, ("a", 3), ("b", 1)), "v").first()[0] == 0.75
    assert shares.top_n_share(numbers(spark), "v", 2).first()[0] == 0.0
    assert shares.top_n_share(numbers(spark, ("a", 3), ("b", 1), ("c", 4)), "v", 2).first()[0] == 0.875
    assert shares.lookup_sum(numbers(spark, ("a", 3), ("a", 1)), "k", "a", "v").first()[0] == 4.0
    assert shares.lookup_sum(numbers(spark), "k", "a", "v").first()[0] == 0.0


def test_pareto(spark):
    found = shares.pareto(numbers(spark, ("b", 2), ("a", 2), ("c", 5), ("d", 1)), "k", "v", 3).collect()
    assert [(r.k, r.cumulative) for r in found] == [("c", 5), ("a", 7), ("b", 9)]
    assert found[-1].cumulative_pct == 100.0
    assert shares.pareto(numbers(spark, ("a", 0)), "k", "v", 3).count() == 0
    assert [shares.pareto_size(n) for n in (5, 15, 50)] == [10, 15, 30]


def test_top_and_reshape(spark):
    assert [r.k for r in shares.top_n(numbers(spark, ("b", 1), ("a", 1), ("c", 0)), "v", 2, "k").collect()] == ["a", "b"]
    wide = spark.createDataFrame([("x", 1, 9), ("y", 5, 5), ("z", 2, 3)], "k string, p int, q int")
    top = shares.top_n_by_max(wide, "p", "q", 2, "k")
    assert [r.k for r in top.collect()] == ["x", "y"]
    assert {tuple(r) for r in shares.layers(top, "k", "p", "q").collect()} == {
        ("x", "p", 1), ("x", "q", 9), ("y", "p", 5), ("y", "q", 5)}
    days = spark.createDataFrame([("d1", "click", 2), ("d1", "purchase", 1), ("d2", "click", 4), ("d2", "wish", 7), ("d2", None, 1)],
                                 "time_bucket string, event_name string, cnt long")
    matrix = shares.heatmap_matrix(days, "time_bucket", "event_name", "cnt").orderBy("time_bucket").collect()
    assert [(r["click"], r["purchase"], r["wish"]) for r in matrix] == [(2, 1, 0), (4, 0, 7)]
    assert [shares.heatmap_size(n) for n in (5, 12, 50)] == [8, 12, 15]
    many = spark.createDataFrame([("d", f"e{i:02d}", i) for i in range(20)],
                                 "time_bucket string, event_name string, cnt long")
    assert {r.event_name for r in shares.keep_top_events(many, 5).collect()} == {f"e{i}" for i in range(12, 20)}


def test_funnel_is_dense(spark):
    counts = spark.createDataFrame([("purchase", 2), ("other", 9)], "event_name string, count long")
    rows = shares.on_funnel(counts, "count").collect()
    assert [r.event_name for r in rows] == list(FUNNEL_STAGES)
    assert [r["count"] for r in rows] == [0] * 7 + [2]


def test_result_kpis(spark):
    result = spark.createDataFrame([("a", 3.7, 1), ("b", None, 2)], "dimension string, revenue_usd double, orders int")
    assert tuple(combined.result_kpis(result).first()) == (2, 3, 2, 1.0)
    assert tuple(combined.result_kpis(result.filter("false")).first()) == (0, 0, 0, 0.0)
    assert tuple(combined.result_kpis(result.select(F.lit(1).alias("x"))).first()) == (2, 0, 0, 0.0)


def test_combined_view(spark):
    batch = spark.createDataFrame([("click", 3), ("purchase", 1), (None, 5)], "event_name string, cnt long")
    counts = spark.createDataFrame([("P", "click", 1), ("P", "refund", 3)],
                                   "product_id string, event_name string, count long")
    rows = {r.event_name: r for r in combined.combined_view(batch, counts).collect()}
    assert (rows["click"].batch_cnt, rows["click"].realtime_cnt, rows["click"].delta_speed_minus_batch) == (3, 1, -2)
    assert (rows["refund"].batch_share_pct, rows["refund"].realtime_share_pct, rows["refund"].share_delta_pp) == (0.0, 75.0, 75.0)
    assert set(rows) == {"click", "purchase", "refund"}
    both = combined.compare(combined.batch_event_counts(batch), combined.realtime_event_counts(counts))
    assert tuple(combined.combined_totals(both).first()) == (4, 4, 0.25, 0.0)
    assert combined.batch_event_counts(batch.select("event_name")).count() == 0


def test_bars_reject_other_metrics(spark, sf_dir):
    with pytest.raises(ValueError):
        pages.dimension_bars(star.clickstream(spark, sf_dir), JANUARY, "os", "buyers")


def records_read(spark, run):
    """Rows that all stages of ``run`` read from files."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0),
                                 gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_pages_read_the_events_once(spark, sf_dir):
    count = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in ("events", "part", "orders")}
    for name in ("event_mix_page", "page_channel", "heatmap_top_events"):
        read = records_read(spark, lambda name=name: all_queries()[name](spark, sf_dir).collect())
        joined = 0 if name == "heatmap_top_events" else count["part"] + count["orders"]
        assert read < count["events"] * 1.9 + joined, name
