"""Every operator as a named query over the test tables.

Money sums are rounded to cents, averages and money shares a little finer, so that results do not
depend on the order of floating-point additions. Counts and shares of counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.files import exists, numbered_folders
from clickloom.functions import scalars
from clickloom.functions.dimensions import DIMENSIONS
from clickloom.functions.timerange import day_range, iso_range
from clickloom.operators import (
    carts,
    combined,
    commerce,
    parsing,
    prices,
    quality,
    reports,
    rollup,
    shares,
    snapshot,
    top,
)
from clickloom.plans import pages
from clickloom.session import run_dir
from clickloom.sinks import upkeep
from clickloom.sinks.tables import export_csv, write_watermark
from clickloom.sources import snapshots, star
from clickloom.sources import tables as table_sources
from clickloom.sources.tables import batch_watermark, event_query, register_events
from clickloom.streaming import carts as streaming_carts
from clickloom.streaming import counts as streaming_counts
from clickloom.streaming import landing, repairs, sessions
from clickloom.streaming import late as late_counts

Query = Callable[[SparkSession, str], DataFrame]

MONEY = ("revenue_usd", "total_sales_usd", "realized_revenue_usd")

MONEY_NEEDS = ("product", "order")


def cents(df: DataFrame, *names: str) -> DataFrame:
    present = [n for n in (*MONEY, *names) if n in df.columns]
    return df.withColumns({n: F.round(n, 2) for n in present})


def joined(values: str) -> Column:
    return F.concat_ws(",", values)


def _needs(by: str) -> tuple[str, ...]:
    first = DIMENSIONS[by].columns[0].split(".")[0]
    return (*MONEY_NEEDS, first) if first in ("customer", "geo") else MONEY_NEEDS


def _money_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.clickstream(spark, sf_dir, *MONEY_NEEDS)


def _plain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.clickstream(spark, sf_dir)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running counts, taken over the whole table at once."""
    return streaming_counts.product_event_counts(_plain_events(spark, sf_dir))


# Historical reports

def overview(spark, sf_dir):
    events = star.clickstream(spark, sf_dir, *MONEY_NEEDS, "customer")
    totals = cents(reports.overview(events, None))
    return totals.withColumn("avg_order_value_usd", F.round("avg_order_value_usd", 4))


def overview_ratios(spark, sf_dir):
    return reports.overview_ratios(reports.overview(_plain_events(spark, sf_dir), None))


def overview_funnel(spark, sf_dir):
    return reports.overview_funnel(reports.overview(_plain_events(spark, sf_dir), None))


def event_mix(spark, sf_dir):
    return cents(reports.event_mix(_money_events(spark, sf_dir), None))


def event_mix_page(spark, sf_dir):
    return cents(pages.event_mix_page(_money_events(spark, sf_dir), None))


def daily_series(spark, sf_dir):
    return cents(reports.daily_series(_money_events(spark, sf_dir), None))


def series_totals(spark, sf_dir):
    totals = reports.series_totals(reports.daily_series(_money_events(spark, sf_dir), None))
    return cents(totals, "avg_daily_revenue_usd", "avg_daily_sales_usd")


def dimension_query(by: str) -> Query:
    def run(spark, sf_dir):
        return cents(reports.dimension_report(
            star.clickstream(spark, sf_dir, *_needs(by)), None, by))

    return run


def page_query(by: str) -> Query:
    """The whole report of a dimension with the shares of its orders."""
    def run(spark, sf_dir):
        return cents(pages.dimension_page(star.clickstream(spark, sf_dir, *_needs(by)), None, by, "orders"))

    return run


def product_query(by: str) -> Query:
    def run(spark, sf_dir):
        return cents(reports.product_report(_money_events(spark, sf_dir), None, by))

    return run


def dimension_bars_query(by: str, metric: str) -> Query:
    """Top values with their shares; money shares are rounded."""
    def run(spark, sf_dir):
        events = star.clickstream(spark, sf_dir, *_needs(by))
        bars = cents(pages.dimension_bars(events, None, by, metric))
        return bars.withColumn("share", F.round("share", 6)).drop("share_pct")

    return run


def product_totals(spark, sf_dir):
    return cents(reports.product_totals(
        reports.product_report(_money_events(spark, sf_dir), None, "category")))


def multi_dimension(spark, sf_dir):
    by = ("channel", "device_type", "event_source", "category", "brand")
    return cents(reports.multi_dimension_report(_money_events(spark, sf_dir), None, by))


def heatmap_day_event(spark, sf_dir):
    return reports.day_event_counts(_plain_events(spark, sf_dir), None)


def heatmap_top_events(spark, sf_dir):
    return pages.heatmap(_plain_events(spark, sf_dir), None)


def heatmap_pivot(spark, sf_dir):
    return shares.heatmap_matrix(
        reports.day_event_counts(_plain_events(spark, sf_dir), None), "time_bucket", "event_name", "cnt")


def hour_distribution(spark, sf_dir):
    return reports.hour_bars(reports.hour_distribution(_plain_events(spark, sf_dir), None))


def base_event_counts(spark, sf_dir):
    return reports.event_counts(_plain_events(spark, sf_dir), None)


def time_range(spark, sf_dir):
    """The range operator itself: both bounds fall between events."""
    period = iso_range("2024-01-08T06:30:00Z", "2024-01-21T18:00:00")
    return reports.event_counts(_plain_events(spark, sf_dir), period)


def day_range_counts(spark, sf_dir):
    """Whole UTC days, both included."""
    return reports.event_counts(_plain_events(spark, sf_dir), day_range(date(2024, 1, 8), date(2024, 1, 15)))


def lenient_numbers(spark, sf_dir):
    """Numbers out of text of all kinds."""
    seq, value = F.col("seq"), F.col("value")
    text = (F.when(seq % 5 == 0, F.format_string("%.2f", "value")).when(seq % 5 == 1, "1e3").when(seq % 5 == 2, "NaN")
            .when(seq % 5 == 3, "none"))
    read = star.base_events(spark, sf_dir).select("seq", F.when(value.isNotNull(), text).alias("text"))
    return read.select("seq", scalars.lenient_long(F.col("text")).alias("whole"),
                       scalars.lenient_double(F.col("text")).alias("number"))


def iso_times(spark, sf_dir):
    """Times out of text in full, without an offset, with one, as a day, and too short to be one."""
    seq, stamp = F.col("seq"), scalars.iso_utc(F.col("event_time"))
    text = (F.when(seq % 5 == 0, stamp).when(seq % 5 == 1, F.substring(stamp, 1, 19))
            .when(seq % 5 == 2, F.concat(F.substring(stamp, 1, 16), F.lit("+0200")))
            .when(seq % 5 == 3, F.substring(stamp, 1, 10)).otherwise(F.substring(stamp, 1, 7)))
    return star.base_events(spark, sf_dir).select("seq", scalars.iso_utc(scalars.parse_iso(text)).alias("at"))


def deduplicated_events(spark, sf_dir):
    """Every event sent twice or more, and kept once."""
    events = star.base_events(spark, sf_dir).select("seq", "event_id", "event_time", "event_name")
    sent = events.unionByName(events).unionByName(events.filter(F.col("seq") % 7 == 0))
    return parsing.first_per_event(sent).groupBy("event_name").agg(
        F.count("*").alias("events"), F.sum("seq").alias("ids"))


def free_sql(spark, sf_dir):
    """Free SQL over the registered event table, in the dialect its users write."""
    register_events(_money_events(spark, sf_dir))
    return event_query(spark, """
        SELECT from_unixtime(unix_timestamp(event_time), 'yyyy-MM') AS month,
               `order`.status AS status,
               COUNT(*) AS purchases,
               ROUND(SUM(COALESCE(revenue, `order`.total, 0.0)), 2) AS revenue_usd
        FROM ecommerce_events
        WHERE event_name = :name
        GROUP BY from_unixtime(unix_timestamp(event_time), 'yyyy-MM'), `order`.status
    """, {"name": "purchase"})


# Running counts

def snapshot_counts(spark, sf_dir):
    """The speed path as a stream: JSON messages, parser, stateful counts, snapshot folder."""
    events = star.events_stream(spark, sf_dir)
    messages = events.select(star.message_of(events).alias("value"))
    folder = run_dir(spark, "snapshot")
    query = streaming_counts.start_counts(
        messages, f"{folder}/counts", f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    return snapshots.ordered_snapshot(snapshots.read_snapshot(spark, f"{folder}/counts"))


def _arriving(spark: SparkSession, rows: DataFrame, run: Callable[[DataFrame], StreamingQuery], parts: int = 3) -> None:
    """Runs a stream to its end after each of several arrivals of ``rows``, by event time."""
    _in_parts(spark, rows, _time_part(rows, parts), run, parts)


def _time_part(rows: DataFrame, parts: int = 3) -> Column:
    """The number of a row's part of the time all rows take."""
    second = F.unix_seconds("event_time")
    low, high = rows.agg(F.min(second), F.max(second)).first()
    width = ((high or 0) - (low or 0)) // parts + 1
    return F.coalesce(F.floor((second - (low or 0)) / width), F.lit(0))


def _in_parts(spark: SparkSession, rows: DataFrame, part: Column, run: Callable[[DataFrame], StreamingQuery], parts: int) -> None:
    """Runs a stream to its end after the arrival of each part. The table is read once, whatever the number of parts."""
    inbox, staged = run_dir(spark, "inbox"), run_dir(spark, "parts")
    rows.withColumn("_part", part.cast("int")).write.partitionBy("_part").parquet(staged)
    for n in range(parts):
        arrival = f"{staged}/_part={n}"
        (spark.read.schema(rows.schema).parquet(arrival) if exists(spark, arrival) else rows.limit(0)).write.mode("append").parquet(inbox)
        run(spark.readStream.schema(rows.schema).parquet(inbox)).awaitTermination()


def _messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.events_stream(spark, sf_dir)
    return events.select(star.message_of(events).alias("value"))


def snapshot_counts_restarted(spark, sf_dir):
    """The same in three starts from one checkpoint, with a base after every second batch."""
    folder = run_dir(spark, "snapshot")
    _arriving(spark, star.base_events(spark, sf_dir), lambda events: streaming_counts.start_counts(
        events.select(star.message_of(events).alias("value")), f"{folder}/counts", f"{folder}/checkpoint",
        available_now=True, compact_every=2))
    return snapshots.ordered_snapshot(snapshots.read_snapshot(spark, f"{folder}/counts"))


def landed_messages(spark, sf_dir):
    """Raw landing: all messages, the broken ones, and the sum of the ids of the others."""
    folder = run_dir(spark, "landing")
    landing.start_landing(_messages_stream(spark, sf_dir), f"{folder}/raw", f"{folder}/checkpoint",
                          available_now=True).awaitTermination()
    whole = F.get_json_object("value", "$.event_id").try_cast("bigint")
    return table_sources.landed_messages(spark, f"{folder}/raw").agg(
        F.count("*").alias("messages"), F.count_if(F.length("value") == 25).alias("broken"),
        F.sum(whole).alias("ids"))


def event_table_stream(spark, sf_dir):
    """Every message sent twice; the event table holds the valid ones once."""
    folder = run_dir(spark, "event_table")
    twice = _messages_stream(spark, sf_dir).select(F.explode(F.array("value", "value")).alias("value"))
    landing.start_event_table(twice, f"{folder}/events", f"{folder}/checkpoint",
                              available_now=True).awaitTermination()
    events = table_sources.event_table(spark, f"{folder}/events")
    return events.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day"), "event_name").agg(
        F.count("*").alias("events"))


def quarantine_stream(spark, sf_dir):
    folder = run_dir(spark, "quarantine")
    landing.start_quarantine(_messages_stream(spark, sf_dir), f"{folder}/bad", f"{folder}/checkpoint",
                             available_now=True).awaitTermination()
    return table_sources.event_table(spark, f"{folder}/bad").groupBy(joined("reasons").alias("reasons")).agg(
        F.count("*").alias("messages"))


def streamed_cart_totals(spark, sf_dir):
    """Cart totals of a stream that is started three times."""
    folder = run_dir(spark, "carts")
    _arriving(spark, star.cart_history(spark, sf_dir), lambda events: streaming_carts.start_cart_replay(
        events, f"{folder}/carts", f"{folder}/checkpoint", available_now=True, compact_every=2))
    return streaming_carts.read_totals(spark, f"{folder}/carts").select(
        "event_id", "cart_id", "event_name", "replayed_qty", "replayed_value")


def late_cart_totals(spark, sf_dir):
    """Cart totals of a stream whose events arrive in any order, put right as they come."""
    folder, events = run_dir(spark, "late_carts"), star.cart_history(spark, sf_dir)
    _in_parts(spark, events, F.pmod(F.xxhash64("event_id"), F.lit(3)), lambda rows: repairs.start_repaired_replay(
        rows, f"{folder}/carts", f"{folder}/checkpoint", available_now=True, late=timedelta(days=366), compact_every=2), 3)
    return repairs.read_repaired(spark, f"{folder}/carts").select(
        "event_id", "cart_id", "event_name", "replayed_qty", "replayed_value")


def _counted_late(spark: SparkSession, sf_dir: str) -> str:
    """Hourly counts of a stream in which every seventh message comes one part too late."""
    events = star.base_events(spark, sf_dir)
    folder = run_dir(spark, "late_windows")
    part = _time_part(events) + F.when(F.col("seq") % 7 == 0, 1).otherwise(0)
    _in_parts(spark, events, part, lambda rows: late_counts.start_counted_windows(
        rows.select(star.message_of(rows).alias("value")), f"{folder}/counts", f"{folder}/checkpoint", "1 hour",
        available_now=True, compact_every=2), 4)
    return f"{folder}/counts"


def late_rows(spark, sf_dir):
    """How many rows came after their window was closed."""
    return late_counts.read_late(spark, _counted_late(spark, sf_dir)).groupBy("event_name").agg(
        F.sum("count").alias("late_rows"), F.count_distinct("window_start").alias("windows"))


def exact_counts_late(spark, sf_dir):
    """Batch up to the middle of the data, windows after it, and the rows that came too late for theirs."""
    path = _counted_late(spark, sf_dir)
    events = parsing.events_from_v1(star.raw_messages(spark, sf_dir))
    middle = events.agg(F.timestamp_seconds(F.min(F.unix_seconds("event_time")) + 500_000).alias("watermark"))
    return streaming_counts.exact_counts(events, late_counts.read_windows(spark, path), middle, "1 hour",
                                         late_counts.read_late(spark, path))


def streamed_sessions(spark, sf_dir):
    """Stages of the sessions that a stream has closed: six hours without an event."""
    folder = run_dir(spark, "sessions")
    sessions.start_sessions(star.events_stream(spark, sf_dir), f"{folder}/runs", f"{folder}/checkpoint", "6 hours",
                            available_now=True).awaitTermination()
    stages = sessions.run_stages(spark.read.parquet(f"{folder}/runs"))
    return stages.withColumns({c: scalars.iso_utc(F.col(c)) for c in ("session_start", "first_time", "last_time")})


def compacted_event_table(spark, sf_dir):
    """The event table of a stream, put in order between its arrivals."""
    folder = run_dir(spark, "kept")
    events = star.base_events(spark, sf_dir).select("seq", "event_time", "event_name", "product_id")
    schema = "seq BIGINT, event_time TIMESTAMP, event_name STRING, product_id STRING, event_date DATE"

    def run(rows: DataFrame) -> StreamingQuery:
        upkeep.compact_days(spark, f"{folder}/events", schema)
        return upkeep.start_kept_events(rows, f"{folder}/events", f"{folder}/checkpoint", available_now=True)

    _in_parts(spark, events, F.pmod(F.col("seq"), F.lit(3)), run, 3)
    kept = upkeep.kept_events(spark, f"{folder}/events", schema)
    return kept.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day"), "event_name").agg(
        F.count("*").alias("events"), F.sum("seq").alias("ids"))


def rollup_channels(spark, sf_dir):
    """Two weeks of channels from a daily rollup made in three goes, with days that late events touched again.

    Sums are exact; the estimated distinct counts are held against the exact report.
    """
    folder = run_dir(spark, "rollup")
    events = star.clickstream(spark, sf_dir, *MONEY_NEEDS).withColumn("event_date", scalars.utc_date(F.col("event_time")))
    third, is_late = _time_part(events), F.pmod(F.xxhash64("event_id"), F.lit(11)) == 0
    for part in (third == 0) & ~is_late, (third == 1) & ~is_late, (third == 2) | is_late:
        events.filter(part).write.mode("append").partitionBy("event_date").parquet(f"{folder}/events")
        rollup.mark_dirty(events.filter(part & is_late), f"{folder}/daily")
        rollup.refresh_rollup(spark, spark.read.parquet(f"{folder}/events"), f"{folder}/daily", "channel")
    period = day_range(date(2024, 1, 8), date(2024, 1, 21))
    found = cents(rollup.report_from(rollup.read_rollup(spark, f"{folder}/daily"), period))
    exact = reports.dimension_report(events.drop("event_date"), period, "channel")
    near = [F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.1 * F.col(f"exact_{c}") for c in rollup.SKETCHES]
    held = exact.select("dimension", *[F.col(c).alias(f"exact_{c}") for c in rollup.SKETCHES])
    return found.join(held, "dimension").select("dimension", *rollup.SUMS, reduce(lambda a, b: a & b, near).alias("estimates_hold"))


def top_visitors(spark, sf_dir):
    """The visitors with most events, counted one by one only in the heaviest hash buckets."""
    found = top.top_values(_plain_events(spark, sf_dir), F.col("user_id"), 15, buckets=1 << 16)
    return found.select(F.col("value").alias("user_id"), "count")


def price_changes(spark, sf_dir):
    """Validity intervals of the prices that shown products had."""
    history = prices.price_history(_shown_prices(spark, sf_dir), ["event_time", "seq"])
    return history.withColumns({c: scalars.iso_utc(F.col(c)) for c in ("valid_from", "valid_to")})


def _shown_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = star.base_events(spark, sf_dir).filter(F.col("event_name").isin("product_view", "click"))
    return shown.select("product_id", "event_time", "seq", F.round("price", -1).alias("price"))


def price_mismatches(spark, sf_dir):
    """Purchases at another price than the one shown last."""
    bought = star.base_events(spark, sf_dir).filter(F.col("event_name") == "purchase")
    lines = bought.select("product_id", "event_time", "seq", F.round("price", -1).alias("price"))
    found = prices.price_mismatches(prices.price_then(lines, _shown_prices(spark, sf_dir), ["event_time", "seq"]))
    return found.select("seq", "product_id", "price", "catalogue_price")


def snapshot_change_feed(spark, sf_dir):
    """What the running counts gained after the first of three starts, read from a compacted folder."""
    folder = run_dir(spark, "snapshot")
    path = f"{folder}/counts"
    _arriving(spark, star.base_events(spark, sf_dir), lambda events: streaming_counts.start_counts(
        events.select(star.message_of(events).alias("value")), path, f"{folder}/checkpoint",
        available_now=True, compact_every=2))
    batches = sorted(numbered_folders(spark, f"{path}/changes", "batch_id"))
    return snapshots.snapshot_changes(spark, path, batches[0], batches[-1])


def json_lines(spark, sf_dir):
    """Messages written as JSON Lines files and read back as binary payloads, as a topic gives them."""
    folder = run_dir(spark, "lines")
    star.raw_messages(spark, sf_dir).select("value").write.text(folder)
    binary = table_sources.event_lines(spark, folder).select(F.col("value").cast("binary").alias("value"))
    events = parsing.speed_events(parsing.message_text(binary))
    return events.groupBy("event_name").agg(F.count("*").alias("events"), F.count("product_id").alias("with_product"))


def csv_round_trip(spark, sf_dir):
    """A report exported as CSV and read back."""
    report = event_mix(spark, sf_dir)
    path = run_dir(spark, "csv")
    export_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def snapshot_latest(spark, sf_dir):
    """Latest counts out of a log of absolute counts, one batch per day."""
    daily = (
        parsing.with_product(_plain_events(spark, sf_dir))
        .groupBy("product_id", "event_name", F.unix_date(F.to_date("event_time")).alias("batch_id"))
        .agg(F.count("*").alias("n"))
    )
    so_far = Window.partitionBy("product_id", "event_name").orderBy("batch_id")
    log = daily.withColumn("count", F.sum("n").over(so_far))
    return snapshots.latest_counts(log)


def snapshot_hashes(spark, sf_dir):
    """Counts into per-product hashes and back."""
    return snapshots.from_hashes(snapshots.to_hashes(_counts(spark, sf_dir)))


def snapshot_query(build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark, sf_dir):
        return build(_counts(spark, sf_dir))

    return run


def drilldown_totals(counts: DataFrame) -> DataFrame:
    return snapshot.drilldown_totals(pages.busiest_product_page(counts))


def display_texts(counts: DataFrame) -> DataFrame:
    """The snapshot by event as display text."""
    page = snapshot.by_event(counts)
    return page.select(
        "event_name",
        scalars.format_int(F.col("count") * 1000).alias("count_text"),
        scalars.format_pct(F.col("share")).alias("share_text"),
        scalars.format_money(F.col("count") * 12.5).alias("money_text"))


def purchase_lookup(counts: DataFrame) -> DataFrame:
    return shares.lookup_sum(snapshot.by_event(counts), "event_name", "purchase", "count")


# Batch next to running counts

def batch_event_counts(spark, sf_dir):
    return combined.batch_event_counts(reports.event_counts(_plain_events(spark, sf_dir), None))


def batch_kpis(spark, sf_dir):
    return combined.result_kpis(reports.event_mix(_plain_events(spark, sf_dir), None))


def combined_view(spark, sf_dir):
    events = _plain_events(spark, sf_dir)
    return combined.combined_view(reports.event_counts(events, None), _counts(spark, sf_dir))


def combined_totals(spark, sf_dir):
    return combined.combined_totals(
        pages.comparison(_plain_events(spark, sf_dir), None, _counts(spark, sf_dir)))


def combined_long(spark, sf_dir):
    return combined.combined_long(
        pages.comparison(_plain_events(spark, sf_dir), None, _counts(spark, sf_dir)), 5)


def _timed(spark, sf_dir):
    return _plain_events(spark, sf_dir).withColumn("event_time_ts", F.col("event_time"))


def windowed_counts(spark, sf_dir):
    windows = streaming_counts.windowed_counts(_timed(spark, sf_dir), "1 hour")
    return windows.withColumn("window_start", scalars.iso_utc(F.col("window_start")))


def exact_counts(spark, sf_dir):
    """Batch up to a watermark in the middle of the data, windows after it."""
    events = _plain_events(spark, sf_dir)
    watermark = events.agg(F.date_trunc("day", F.timestamp_seconds(
        (F.min(F.unix_seconds("event_time")) + F.max(F.unix_seconds("event_time"))) / 2)
    ).alias("watermark"))
    windows = streaming_counts.windowed_counts(_timed(spark, sf_dir), "1 hour")
    return streaming_counts.exact_counts(events, windows, watermark, "1 hour")


def exact_counts_unaligned(spark, sf_dir):
    """The same with a watermark inside a window, as the batch writer stores it."""
    events = _plain_events(spark, sf_dir)
    folder = run_dir(spark, "watermark")
    early = events.agg(F.timestamp_seconds(F.min(F.unix_seconds("event_time")) + 500_000).alias("at")).scalar()
    write_watermark(events.filter(F.col("event_time") < early), folder)
    windows = streaming_counts.windowed_counts(_timed(spark, sf_dir), "1 hour")
    return streaming_counts.exact_counts(events, windows, batch_watermark(spark, folder), "1 hour")


# Messages, carts, orders, sessions

def parsed_events(spark, sf_dir):
    """Messages parsed into the event table's shape, summed up by day and device."""
    events = parsing.events_from_v1(star.raw_messages(spark, sf_dir))
    return events.groupBy(
        F.date_format("event_date", "yyyy-MM-dd").alias("day"), "event_name",
        F.col("device.device_type").alias("device_type"),
    ).agg(
        F.count("*").alias("events"), F.count("order.order_id").alias("with_order"),
        F.sum("quantity").alias("quantity"), F.round(F.sum("order.total"), 2).alias("order_total"))


def contract_violations(spark, sf_dir):
    checked = quality.checked_messages(star.raw_messages(spark, sf_dir), ("seq",))
    return quality.quarantined(checked, ("seq",)).select("seq", joined("reasons").alias("reasons"))


def violation_counts(spark, sf_dir):
    return quality.violation_counts(quality.checked_messages(star.raw_messages(spark, sf_dir)))


def cart_replay(spark, sf_dir):
    replayed = carts.cart_replay(star.cart_history(spark, sf_dir))
    return replayed.select("event_id", "cart_id", "event_name", "replayed_qty", "replayed_value")


def cart_mismatches(spark, sf_dir):
    """Cart events of every sixth hour record a wrong quantity, or none."""
    hour = scalars.hour_bucket(F.col("event_time"))
    wrong = F.when(hour % 12 != 0, F.col("replayed_qty") + 1)
    replayed = carts.cart_replay(star.cart_history(spark, sf_dir))
    recorded = replayed.withColumn("cart_items_qty", F.when(hour % 6 == 0, wrong).otherwise(
        F.col("replayed_qty"))).withColumn("cart_value", F.col("replayed_value"))
    return carts.cart_mismatches(recorded).select("event_id", "replayed_qty")


def cart_rules(spark, sf_dir):
    found = quality.cart_rule_violations(star.cart_history(spark, sf_dir))
    return found.select("event_id", "held_qty", joined("reasons").alias("reasons"))


def event_table_orders(spark, sf_dir):
    """Order lines from messages by way of the event table."""
    lines = commerce.order_lines(parsing.events_from_v1(star.raw_messages(spark, sf_dir)))
    return lines.filter(F.col("order_id").isNotNull()).select(
        F.col("event_id").cast("bigint").alias("seq"), "order_id", F.col("product_id").alias("line_product"))


def line_total_mismatches(spark, sf_dir):
    lines = commerce.order_lines(star.order_events(spark, sf_dir))
    return commerce.line_total_mismatches(lines).select("event_id", "line")


def session_stages(spark, sf_dir):
    stages = quality.session_stages(_plain_events(spark, sf_dir))
    return stages.select(
        "session_id", "event_name", scalars.iso_utc(F.col("first_time")).alias("first_time"),
        scalars.iso_utc(F.col("last_time")).alias("last_time"), "events")


def session_conformance(spark, sf_dir):
    found = quality.session_violations(star.cart_history(spark, sf_dir))
    return found.select("session_id", "event_id", "event_name", joined("reasons").alias("reasons"))


def order_lines(spark, sf_dir):
    lines = commerce.order_lines(star.order_events(spark, sf_dir))
    return lines.select("event_id", "order_id", "line", "product_id", "category", "price",
                        "quantity", "line_total")


def product_sales(spark, sf_dir):
    sales = commerce.product_sales(commerce.order_lines(star.order_events(spark, sf_dir)))
    return cents(sales, "revenue")


def order_reconciliation(spark, sf_dir):
    found = quality.order_reconciliation(star.order_events(spark, sf_dir))
    return found.withColumn("differing", joined("differing"))


def product_catalog(spark, sf_dir):
    lines = commerce.order_lines(star.order_events(spark, sf_dir))
    catalog = commerce.product_catalog(_plain_events(spark, sf_dir), lines)
    return catalog.withColumn("last_seen", scalars.iso_utc(F.col("last_seen")))


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        f.__name__: f for f in (
            overview, overview_ratios, overview_funnel, event_mix, event_mix_page, daily_series,
            series_totals, product_totals, multi_dimension, heatmap_day_event, heatmap_top_events,
            heatmap_pivot, hour_distribution, base_event_counts, time_range, free_sql,
            snapshot_counts, snapshot_latest, snapshot_hashes, batch_event_counts, batch_kpis,
            combined_view, combined_totals, combined_long, windowed_counts, exact_counts,
            parsed_events, contract_violations, violation_counts, cart_replay, session_stages,
            session_conformance, order_lines, product_sales, order_reconciliation,
            product_catalog, day_range_counts, lenient_numbers, iso_times, deduplicated_events,
            exact_counts_unaligned, cart_mismatches, event_table_orders, line_total_mismatches,
            snapshot_counts_restarted, landed_messages, event_table_stream, quarantine_stream,
            streamed_cart_totals, csv_round_trip, cart_rules, late_cart_totals, late_rows, exact_counts_late,
            streamed_sessions, compacted_event_table, rollup_channels, top_visitors, price_changes, price_mismatches,
            snapshot_change_feed, json_lines,
        )
    }
    found.update({f"dim_{name}": dimension_query(name) for name in DIMENSIONS})
    found.update({f"page_{name}": page_query(name) for name in DIMENSIONS})
    found.update({f"product_{name}": product_query(name) for name, d in DIMENSIONS.items()
                  if d.group == "product"})
    found.update({
        "top_channels": dimension_bars_query("channel", "orders"),
        "top_countries": dimension_bars_query("customer_country", "buyers"),
        "top_products": dimension_bars_query("product", "total_sales_usd"),
        "top_cities": dimension_bars_query("city", "revenue_usd"),
    })
    found.update({name: snapshot_query(build) for name, build in {
        "snapshot_by_event": pages.snapshot_events_page,
        "snapshot_by_product": pages.snapshot_products_page,
        "snapshot_mix": snapshot.mix_matrix,
        "snapshot_kpis": snapshot.kpis,
        "funnel_snapshot": pages.funnel_page,
        "funnel_ratios": snapshot.funnel_ratios,
        "purchase_products": pages.purchases_page,
        "pareto_events": pages.pareto_of_events,
        "pareto_products": pages.pareto_of_products,
        "drilldown_candidates": snapshot.drilldown_candidates,
        "drilldown": pages.busiest_product_page,
        "drilldown_totals": drilldown_totals,
        "display_texts": display_texts,
        "purchase_lookup": purchase_lookup,
    }.items()})
    return found

