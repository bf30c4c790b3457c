"""Daily rollups, top values, price history, snapshots as of a batch, run scopes, and small wrong answers of before."""

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.files import numbered_folders
from clickloom.functions.scalars import utc_date
from clickloom.functions.timerange import TimeRange, day_range
from clickloom.operators import parsing, prices, reports, rollup, shares, top
from clickloom.session import cleared, run_dir, settle, shared_dir
from clickloom.sinks.snapshots import compact_snapshot, drop_compacted, upsert_counts
from clickloom.sources import snapshots, star, streams
from test_repairs import scanned

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    rows = star.clickstream(spark, sf_dir, "product", "order")
    return rows.withColumn("event_date", utc_date(F.col("event_time"))).cache()


def rows_of(df, *names):
    return sorted((tuple(round(v, 2) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=str)


def test_only_new_and_dirty_days_are_rolled_up(spark, events, tmp_path):
    path, table = str(tmp_path / "daily"), str(tmp_path / "events")
    split = F.lit(datetime(2024, 1, 10, 12, tzinfo=timezone.utc))
    late = F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0
    events.filter((F.col("event_time") < split) & ~late).write.partitionBy("event_date").parquet(table)
    stored = spark.read.parquet(table)
    first = rollup.refresh_rollup(spark, stored, path, "channel")
    assert len(first) == stored.select("event_date").distinct().count()

    fresh = events.filter((F.col("event_time") >= split) & ~late | late & (F.col("event_date") == date(2024, 1, 3)))
    assert fresh.filter(late).count() > 0
    fresh.write.mode("append").partitionBy("event_date").parquet(table)
    rollup.mark_dirty(fresh.filter(late), path)
    stored = spark.read.parquet(table)
    days = rollup.stale_days(spark, stored, path)
    # The day of the stored time, those after it, and the day that late events touched.
    assert days[:2] == ["2024-01-03", "2024-01-10"] and len(days) == 1 + stored.filter("event_date >= '2024-01-10'").select("event_date").distinct().count()
    read = rollup.of_days(stored, days).select("event_id", "event_date")
    assert {str(r.event_date) for r in read.collect()} == set(days)
    wanted = [f for f in stored.inputFiles() if f.split("event_date=")[1][:10] in days]
    assert scanned(read._jdf.queryExecution().executedPlan(), "numFiles") == [len(wanted)] and len(wanted) < len(stored.inputFiles())
    assert rollup.refresh_rollup(spark, stored, path, "channel") == days
    assert rollup.refresh_rollup(spark, stored, path, "channel") == days[-1:]
    assert numbered_folders(spark, f"{path}/dirty", "mark") == {}

    kept, whole = rollup.read_rollup(spark, path), rollup.daily_rollup(stored, "channel")
    names = ("event_date", "dimension", *rollup.SUMS)
    assert rows_of(kept, *names) == rows_of(whole, *names)


def test_ranges_from_the_rollup(events):
    made = rollup.daily_rollup(events, "device_type")
    for period in (None, day_range(date(2024, 1, 5), date(2024, 1, 9))):
        exact = reports.dimension_report(events, period, "device_type")
        found = rollup.report_from(made, period)
        sums = ("dimension", "events", "units_sold", "revenue_usd", "total_sales_usd")
        assert rows_of(found, *sums) == rows_of(exact, *sums)
        estimates = {r.dimension: r for r in found.collect()}
        for r in exact.collect():
            for name in rollup.SKETCHES:
                assert abs(estimates[r.dimension][name] - r[name]) <= max(1, 0.05 * r[name])
    with pytest.raises(ValueError):
        rollup.report_from(made, TimeRange(START, START + timedelta(hours=5)))


def test_estimates_keep_their_error(spark):
    n = 200_000
    many = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 864_000).alias("event_time"), F.lit("purchase").alias("event_name"),
        F.col("id").cast("string").alias("user_id"), (F.col("id") % 7).cast("string").alias("session_id"), F.lit(1).alias("quantity"),
        F.lit(1.0).alias("price"), F.lit(2.0).alias("revenue"), F.lit("web").alias("event_source"),
        F.struct(F.col("id").cast("string").alias("order_id"), F.lit(1.0).alias("total")).alias("order"),
        F.struct(F.lit(1).alias("quantity"), F.lit(1.0).alias("price")).alias("product"))
    row = rollup.report_from(rollup.daily_rollup(many, "event_source")).first()
    assert row.events == n and row.sessions == 7 and row.revenue_usd == 2.0 * n
    for name in ("users", "orders", "buyers"):
        assert abs(row[name] - n) < 0.05 * n  # three standard errors


@pytest.mark.parametrize("kind", ["skewed", "flat", "few", "none"])
def test_top_values_are_exact(spark, kind, monkeypatch):
    counted = []
    own = top._counted
    monkeypatch.setattr(top, "_counted", lambda rows, n: counted.append(1) or own(rows, n))
    value = {"skewed": F.floor(F.sqrt(F.sqrt("id") * 40)), "flat": F.col("id") % 5000, "few": F.col("id") % 6, "none": F.lit(None)}[kind]
    rows = spark.range(60_000 if kind != "skewed" else 300_000).select(value.cast("string").alias("v")).filter(
        "v is null or v != '3'")
    found = [tuple(r) for r in top.top_values(rows, F.col("v"), 5, buckets=4096).collect()]
    every = rows.filter("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").limit(5)
    assert found == [tuple(r) for r in every.collect()]
    # Flat data give no proof, so all values are counted.
    assert len(counted) == {"skewed": 1, "flat": 2, "few": 1, "none": 1}[kind]


def seen(spark, *rows):
    return spark.createDataFrame([(p, START + timedelta(hours=h) if h is not None else None, n, v) for n, (p, h, v) in enumerate(rows)],
                                 "product_id string, event_time timestamp, id long, price double")


@pytest.mark.parametrize("ranges", [1, 5])
def test_price_history(spark, ranges):
    points = seen(spark, ("A", 0, 5.0), ("A", 1, 5.0), ("A", 2, 6.0), ("A", 2, 7.0), ("B", 0, 1.0), ("A", 9, None), (None, 1, 3.0),
                  ("C", None, 2.0), *[("H", h, float(h // 10)) for h in range(100)])
    found = {}
    for r in prices.price_history(points, ["event_time", "id"], ranges).collect():
        hours = [t and round((t.replace(tzinfo=timezone.utc) - START).total_seconds() / 3600) for t in (r.valid_from, r.valid_to)]
        found.setdefault(r.product_id, []).append((r.price, *hours))
    assert sorted(found["A"], key=str) == [(5.0, 0, 2), (6.0, 2, 2), (7.0, 2, None)]
    assert found["B"] == [(1.0, 0, None)] and set(found) == {"A", "B", "H"}
    assert sorted(found["H"]) == [(float(i), 10 * i, 10 * i + 10 if i < 9 else None) for i in range(10)]

    lines = seen(spark, ("A", 1, 5.0), ("A", 2, 6.0), ("B", 5, 2.0), ("C", 1, 2.0), (None, 3, 1.0), ("B", None, 1.0),
                 *[("H", h, 3.0) for h in range(100)])
    priced = prices.price_then(lines, points, ["event_time", "id"], ranges)
    then = {(r.product_id, r.id): r.catalogue_price for r in priced.collect()}
    assert len(then) == 106 and [then["A", 0], then["A", 1], then["B", 2], then["C", 3], then[None, 4], then["B", 5]] == [5, 7, 1, None, None, None]
    assert [then["H", 6 + h] for h in range(100)] == [float(h // 10) for h in range(100)]
    assert prices.price_mismatches(priced).count() == 2 + 90


COUNTS = "product_id string, event_name string, count long"


def test_snapshot_as_of_a_batch(spark, tmp_path):
    path, write = str(tmp_path), upsert_counts(str(tmp_path), epoch=0)
    write(spark.createDataFrame([("A", "click", 1), ("B", "click", 5)], COUNTS), 0)
    write(spark.createDataFrame([("A", "click", 3)], COUNTS), 1)
    write(spark.createDataFrame([("A", "click", 4), ("C", "click", 1), ("B", "click", 5)], COUNTS), 2)

    def at(n):
        return {r.product_id: r["count"] for r in snapshots.read_snapshot(spark, path, as_of=n).collect()}

    def changed(a, b):
        return sorted((r.product_id, r.before, r["count"], r.delta) for r in snapshots.snapshot_changes(spark, path, a, b).collect())

    wanted = [{"A": 1, "B": 5}, {"A": 3, "B": 5}, {"A": 4, "B": 5, "C": 1}]
    for _ in range(2):
        assert [at(n) for n in range(3)] == wanted
        assert changed(0, 2) == [("A", 1, 4, 3), ("C", None, 1, 1)] and changed(1, 1) == []
        compact_snapshot(spark, path)
    write(spark.createDataFrame([("B", "click", 9)], COUNTS), 3)
    drop_compacted(spark, path)
    assert at(2) == wanted[2] and at(3) == {**wanted[2], "B": 9} and changed(2, 3) == [("B", 5, 9, 4)]
    with pytest.raises(ValueError):
        at(1)


def test_heatmap_keeps_an_event_named_null(spark):
    rows = spark.createDataFrame([("d1", "null", 3), ("d1", "click", 2), ("d2", None, 4)], "day string, name string, n long")
    wide = shares.heatmap_matrix(rows, "day", "name", "n")
    assert wide.columns == ["day", "click", "null"]
    assert sorted(map(tuple, wide.collect())) == [("d1", 2, 3), ("d2", 0, 0)]
    assert shares.heatmap_matrix(rows.filter("name is null"), "day", "name", "n").collect()[0][0] == "d2"
    spark.conf.set("spark.sql.pivotMaxValues", 1)
    try:
        with pytest.raises(ValueError):
            shares.heatmap_matrix(rows, "day", "name", "n")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_first_event_does_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([("1", START, "b"), ("1", START, "d"), ("1", None, "a"), ("1", START, "c"), (None, None, "x")],
                                 "event_id string, event_time timestamp, payload string")
    found = [sorted(r.payload for r in parsing.first_per_event(rows.repartition(n).orderBy(F.rand(n))).collect()) for n in (1, 2, 3, 5)]
    assert all(f == found[0] for f in found) and len(found[0]) == 2 and "a" not in found[0]


def test_hashes_of_many_event_names(spark):
    counts = spark.range(500).select(F.lit("P").alias("product_id"), F.concat(F.lit("e"), "id").alias("event_name"), F.col("id").alias("count"))
    hashes = snapshots.to_hashes(counts, most=50)
    assert 5 < hashes.count() <= 10 and hashes.select(F.max(F.size("stats"))).first()[0] < 120
    assert rows_of(snapshots.from_hashes(hashes), "product_id", "event_name", "count") == rows_of(counts, "product_id", "event_name", "count")


def test_a_run_leaves_nothing_behind(spark, sf_dir, tmp_path):
    from clickloom.plans.queries import all_queries

    before = set(os.listdir(shared_dir(spark)))
    with cleared(spark):
        settle(spark.range(3), "kept").count()
        os.makedirs(run_dir(spark, "made").removeprefix("file:"))
        all_queries()["cart_replay"](spark, sf_dir).write.parquet(str(tmp_path / "out"))
    assert set(os.listdir(shared_dir(spark))) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_topic_options():
    class Reader:
        def __init__(self):
            self.options, self.kind = {}, None

        def format(self, kind):
            self.kind = kind
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            return self

        def select(self, *columns):
            self.selected = len(columns)
            return self

    class Session:
        readStream = Reader()

    found = streams.event_stream(Session(), "kafka", servers="a:1,b:2", topic="t", maxOffsetsPerTrigger="5")
    assert found.kind == "kafka" and found.selected == 3
    assert found.options == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "5"}


# Ranked results: the columns each promises to be ordered by, minus for descending.
REPORT = ("-total_sales_usd", "-revenue_usd", "-orders", "-events", "dimension")
ORDERED = {
    "event_mix": ("-events", "event_name"), "daily_series": ("time_bucket",), "dim_channel": REPORT, "dim_customer_country": REPORT,
    "top_visitors": ("-count", "user_id"), "product_sales": ("-revenue", "product_id"), "snapshot_counts": ("-count", "product_id", "event_name"),
    "drilldown_candidates": ("-count", "product_id"), "funnel_snapshot": ("pos",)}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_ranked_results_are_in_order(spark, sf_dir, name):
    from clickloom.plans.queries import all_queries

    rows = [r.asDict() for r in all_queries()[name](spark, sf_dir).collect()]
    assert len(rows) > 1

    def key(row):
        return tuple(-row[k[1:]] if k.startswith("-") else row[k] for k in ORDERED[name])

    assert rows == sorted(rows, key=key)
