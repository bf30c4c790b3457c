from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.functions import scalars
from clickloom.functions.dimensions import DIMENSIONS, check_metric, dimension
from clickloom.functions.timerange import TimeRange, day_range, iso_range, recent_days
from clickloom.operators import reports

UTC = timezone.utc


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_numbers(spark):
    row = one(
        spark,
        a=scalars.safe_ratio(F.lit(1), F.lit(0)), b=scalars.safe_ratio(F.lit(1), F.lit(4)),
        c=scalars.safe_ratio(F.lit(1), F.lit(None).cast("int")),
        d=scalars.lenient_long(F.lit("x")), e=scalars.lenient_double(F.lit("2.5")),
        f=scalars.round_even(F.lit(0.125)), g=scalars.round_even(F.lit(0.375)),
        h=scalars.share_pct(F.lit(0.00125)))
    assert tuple(row) == (0.0, 0.25, 0.0, 0, 2.5, 0.12, 0.38, 0.12)


def test_texts(spark):
    row = one(
        spark, a=scalars.format_int(F.lit(1234567)), b=scalars.format_pct(F.lit(0.1225)),
        c=scalars.format_money(F.lit(1234.5)),
        d=scalars.snapshot_key(F.lit("SKU1")), e=scalars.product_of_key(F.lit("realtime:stats:a:b")),
        f=scalars.iso_utc(F.lit(datetime(2026, 2, 28, 10, 0, 0, 900000, UTC))))
    assert tuple(row) == ("1.234.567", "12.2%", "US$ 1,234.50", "realtime:stats:SKU1", "b",
                          "2026-02-28T10:00:00Z")


@pytest.mark.parametrize("text, hour", [
    ("2026-02-28T10:00:00Z", 10), ("2026-02-28T10:00:00+02", 8), ("2026-02-28T10:00:00+0230", 7),
    ("2026-02-28T10:00:00+02:00", None), ("2026-02-28T10:00:00.123Z", None),
    ("2026-2-8T1:0:0Z", None), ("garbage", None), (None, None)])
def test_event_time(spark, text, hour):
    row = one(spark, h=F.hour(scalars.parse_event_time(F.lit(text).cast("string"))))
    assert row.h == hour


@pytest.mark.parametrize("text, hour", [
    ("2026-02-28T10:00:00Z", 10), (" 2026-02-28T10:00:00 ", 10), ("2026-02-28T10:00:00+02:00", 8),
    ("2026-02-28T10:00", 10), ("2026-02-28", 0), ("2026-02-28T10:00:00+0200", 8), ("2026-02-28T10:00:00.5Z", 10),
    ("2026", None), ("2026-02", None), ("2026-2-8", None), ("10:00:00", None), ("T12:00", None),
    ("soon", None)])
def test_iso(spark, text, hour):
    assert one(spark, h=F.hour(scalars.parse_iso(F.lit(text)))).h == hour


def test_dimensions():
    assert len(DIMENSIONS) == 19
    assert [n for n, d in DIMENSIONS.items() if d.purchase_only] == [
        "order_status", "payment_method", "payment_provider"]
    assert check_metric("channel", "sessions") == "sessions"
    with pytest.raises(ValueError):
        check_metric("segment", "sessions")
    with pytest.raises(ValueError):
        dimension("weather")


def test_ranges():
    day = day_range(date(2024, 1, 1), date(2024, 1, 1))
    assert (day.start, day.end) == (datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, tzinfo=UTC))
    assert iso_range("2024-01-01T00:00:00Z", "2024-01-02T00:00:00") == day
    assert recent_days(datetime(2024, 1, 2, 5, tzinfo=UTC)) == day_range(date(2024, 1, 1), date(2024, 1, 2))
    with pytest.raises(ValueError):
        day_range(date(2024, 1, 2), date(2024, 1, 1))
    with pytest.raises(ValueError):
        TimeRange(datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_range_is_half_open_and_prunes(spark, tmp_path):
    from clickloom.sinks.tables import write_events
    from clickloom.sources.tables import event_table

    times = [datetime(2024, 1, d, h, tzinfo=UTC) for d in (1, 2, 3, 4) for h in (0, 12)]
    rows = spark.createDataFrame(
        [(t, "click", "U") for t in times], "event_time timestamp, event_name string, user_id string")
    write_events(rows, str(tmp_path / "events"))
    period = day_range(date(2024, 1, 2), date(2024, 1, 3))
    counted = reports.event_counts(event_table(spark, str(tmp_path / "events")), period)
    assert [tuple(r) for r in counted.collect()] == [("click", 4)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan
    assert "user_id" not in plan


def test_text_numbers(spark):
    row = one(
        spark, a=scalars.lenient_long(F.lit("3.7")), b=scalars.lenient_long(F.lit("1e3")),
        c=scalars.lenient_double(F.lit("NaN")), d=scalars.lenient_long(F.lit("NaN")),
        e=scalars.format_pct(F.lit(0.0015)), f=scalars.format_money(F.lit(0.615)))
    assert tuple(row) == (3, 1000, 0.0, 0, "0.1%", "US$ 0.61")


@pytest.mark.parametrize("zone", ["UTC", "America/Lima", "Asia/Tokyo"])
def test_days_are_utc_in_any_session(spark, tmp_path, zone):
    from clickloom.sinks.tables import write_events
    from clickloom.sources.tables import event_table

    before = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.createDataFrame([(datetime(2024, 1, 2, 2, 30, tzinfo=UTC), "click")], "event_time timestamp, event_name string")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        write_events(rows, str(tmp_path / "events"))
        events = event_table(spark, str(tmp_path / "events"))
        assert reports.event_counts(events, day_range(date(2024, 1, 2), date(2024, 1, 2))).count() == 1
        row = events.select(scalars.day_bucket(F.col("event_time")).alias("d"), scalars.hour_bucket(F.col("event_time")).alias("h"),
                            scalars.iso_utc(F.col("event_time")).alias("i"),
                            scalars.iso_utc(scalars.parse_iso(F.lit("2024-01-02T02:30:00"))).alias("p")).first()
        assert tuple(row) == ("2024-01-02", 2, "2024-01-02T02:30:00Z", "2024-01-02T02:30:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
