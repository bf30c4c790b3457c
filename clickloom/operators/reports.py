"""Historical business reports over the event table.

Distinct counts are exact. Spark expands each row once per distinct column, removes duplicates
before the shuffle and shuffles by group and value together, so one group or one user holding a
large part of the rows does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.dimensions import UNKNOWN, Dimension, dimension
from clickloom.functions.measures import (
    is_event,
    is_purchase,
    purchase_amount,
    purchase_order,
    purchase_user,
    total_sales,
    units_sold,
)
from clickloom.functions.scalars import day_bucket, hour_bucket, safe_ratio
from clickloom.functions.timerange import TimeRange, within
from clickloom.schemas import FUNNEL_STAGES


def _count_of(event_name: str) -> Column:
    return F.sum(F.when(is_event(event_name), 1).otherwise(0))


def _on_purchase(value: Column, otherwise: Column) -> Column:
    return F.sum(F.when(is_purchase(), value).otherwise(otherwise))


def _measure(name: str, alias: str | None = None) -> Column:
    """A report measure by its output name."""
    columns = {
        "events": lambda: F.count("*"),
        "users": lambda: F.countDistinct("user_id"),
        "sessions": lambda: F.countDistinct("session_id"),
        "customers": lambda: F.countDistinct("customer.customer_id"),
        "orders": lambda: F.countDistinct(purchase_order()),
        "buyers": lambda: F.countDistinct(purchase_user()),
        "product_views": lambda: _count_of("product_view"),
        "add_to_cart": lambda: _count_of("add_to_cart"),
        "begin_checkout": lambda: _count_of("begin_checkout"),
        "purchase_events": lambda: _count_of("purchase"),
        "units_sold": lambda: _on_purchase(units_sold(), F.lit(0)),
        "revenue_usd": lambda: _on_purchase(purchase_amount(), F.lit(0.0)),
        "total_sales_usd": lambda: _on_purchase(total_sales(), F.lit(0.0)),
    }
    return columns[name]().alias(alias or name)


def _measures(*names: str) -> list[Column]:
    return [_measure(name) for name in names]


def overview(events: DataFrame, period: TimeRange | None) -> DataFrame:
    """One row of totals. Sums and the average are null when the period holds no event."""
    return within(events, period).agg(
        _measure("events", "total_events"),
        *_measures("users", "sessions", "customers"),
        *[_count_of(stage).alias(stage) for stage in FUNNEL_STAGES],
        _measure("orders", "distinct_orders"),
        *_measures("buyers", "units_sold"),
        _measure("revenue_usd", "realized_revenue_usd"),
        _measure("total_sales_usd"),
        F.avg(F.when(is_purchase(), purchase_amount())).alias("avg_order_value_usd"),
    )


def event_mix(events: DataFrame, period: TimeRange | None) -> DataFrame:
    return (
        within(events, period).groupBy("event_name")
        .agg(*_measures("events", "users", "sessions", "orders", "units_sold", "revenue_usd",
                        "total_sales_usd"))
        .orderBy(F.desc("events"), "event_name")
    )


def daily_series(events: DataFrame, period: TimeRange | None) -> DataFrame:
    """One row per day that has events."""
    return (
        within(events, period).groupBy(day_bucket(F.col("event_time")).alias("time_bucket"))
        .agg(
            _measure("events", "total_events"),
            *_measures("sessions", "users", "product_views", "add_to_cart", "begin_checkout",
                       "purchase_events", "orders", "units_sold", "revenue_usd",
                       "total_sales_usd"),
        )
        .orderBy("time_bucket")
    )


def dimension_report(events: DataFrame, period: TimeRange | None, by: str | Dimension) -> DataFrame:
    """Measures per value of a dimension; some dimensions look at purchases only."""
    chosen = dimension(by) if isinstance(by, str) else by
    rows = within(events, period)
    if chosen.purchase_only:
        rows = rows.filter(is_purchase())
    return (
        rows.groupBy(chosen.column().alias("dimension"))
        .agg(*_measures("events", "sessions", "users", "orders", "buyers", "units_sold",
                        "revenue_usd", "total_sales_usd"))
        .orderBy(F.desc("total_sales_usd"), F.desc("revenue_usd"), F.desc("orders"),
                 F.desc("events"), "dimension")
    )


def product_report(events: DataFrame, period: TimeRange | None, by: str | Dimension) -> DataFrame:
    """Shopping measures per product attribute, leaving out events without one."""
    chosen = dimension(by) if isinstance(by, str) else by
    return (
        within(events, period).filter(chosen.column() != UNKNOWN)
        .groupBy(chosen.column().alias("dimension"))
        .agg(*_measures("product_views", "add_to_cart", "begin_checkout", "purchase_events",
                        "orders", "buyers", "units_sold", "revenue_usd", "total_sales_usd"))
        .orderBy(F.desc("total_sales_usd"), F.desc("revenue_usd"), F.desc("orders"),
                 F.desc("product_views"), "dimension")
    )


def day_event_counts(events: DataFrame, period: TimeRange | None) -> DataFrame:
    return (
        within(events, period)
        .groupBy(day_bucket(F.col("event_time")).alias("time_bucket"), "event_name")
        .agg(F.count("*").alias("cnt"))
    )


def hour_distribution(events: DataFrame, period: TimeRange | None) -> DataFrame:
    return (
        within(events, period).groupBy(hour_bucket(F.col("event_time")).alias("hour_of_day"))
        .agg(F.count("*").alias("cnt"), _measure("purchase_events"))
        .orderBy("hour_of_day")
    )


def event_counts(events: DataFrame, period: TimeRange | None) -> DataFrame:
    return (
        within(events, period).groupBy("event_name").agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "event_name")
    )


def series_totals(series: DataFrame) -> DataFrame:
    """Totals and per-day averages over a daily series; days without events do not count."""
    dated = series.filter(F.col("time_bucket").try_cast("date").isNotNull())

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return dated.agg(
        F.count("*").alias("days"),
        total("revenue_usd").alias("revenue_usd"),
        total("total_sales_usd").alias("total_sales_usd"),
        total("units_sold").alias("units_sold"),
        total("orders").alias("orders"),
        safe_ratio(total("revenue_usd"), F.count("*")).alias("avg_daily_revenue_usd"),
        safe_ratio(total("total_sales_usd"), F.count("*")).alias("avg_daily_sales_usd"),
    )


def hour_bars(distribution: DataFrame) -> DataFrame:
    """Hour rows with a readable hour, in order of the hour."""
    hour = F.col("hour_of_day").try_cast("int")
    return (
        distribution.withColumn("hour_of_day", hour).filter(F.col("hour_of_day").isNotNull())
        .orderBy("hour_of_day")
    )


def product_totals(report: DataFrame) -> DataFrame:
    """Sums over a product report's rows; an order seen under two products counts twice."""
    names = ("product_views", "add_to_cart", "orders", "units_sold", "revenue_usd",
             "total_sales_usd")
    return report.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def overview_ratios(totals: DataFrame) -> DataFrame:
    """Conversion ratios of an overview row."""
    def ratio(num: str, den: str) -> Column:
        return safe_ratio(F.col(num), F.col(den))

    return totals.select(
        ratio("add_to_cart", "product_view").alias("view_to_cart"),
        ratio("begin_checkout", "add_to_cart").alias("cart_to_checkout"),
        ratio("purchase", "begin_checkout").alias("checkout_to_purchase"),
    )


def overview_funnel(totals: DataFrame) -> DataFrame:
    """The overview's stage counts as rows in funnel order."""
    zeroed = totals.select(*[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in FUNNEL_STAGES])
    rows = zeroed.unpivot([], list(FUNNEL_STAGES), "event_name", "count")
    position = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STAGES]), F.col("event_name"))
    return rows.select(position.cast("int").alias("pos"), "event_name", "count").orderBy("pos")


def multi_dimension_report(events: DataFrame, period: TimeRange | None, by: tuple[str, ...]) -> DataFrame:
    """Several dimension reports in one scan: one grouping set per dimension.

    Purchase-only dimensions are left out, as their rows differ.
    """
    chosen = {name: dimension(name) for name in by}
    if any(d.purchase_only for d in chosen.values()):
        raise ValueError("purchase-only dimensions cannot share a scan with the others")
    named = within(events, period).select(
        "*", *[d.column().alias(f"by_{name}") for name, d in chosen.items()])
    keys = [f"by_{name}" for name in by]
    kept = F.coalesce(*[F.when(F.grouping(key) == 0, name) for key, name in zip(keys, by)])
    return (
        named.groupingSets([[key] for key in keys], *keys)
        .agg(kept.alias("dimension_name"), F.coalesce(*keys).alias("dimension"),
             *_measures("events", "units_sold", "revenue_usd", "total_sales_usd"))
        .drop(*keys)
    )
