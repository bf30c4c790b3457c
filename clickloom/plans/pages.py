"""Report tables as a reader sees them: measures, shares, rankings.

A report over the event table that needs a total or a ranking of its own rows is written once, as it would be computed
from all events a second time otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.dimensions import check_metric, dimension
from clickloom.functions.scalars import round_even
from clickloom.functions.timerange import TimeRange
from clickloom.operators import combined, reports, shares, snapshot
from clickloom.session import settle

DEFAULT_ROWS = 15


def event_mix_page(events: DataFrame, period: TimeRange | None) -> DataFrame:
    """Event mix with each event's share of all events."""
    report = settle(reports.event_mix(events, period), "report")
    return shares.add_share_pct(shares.add_share(report, "events"))


def dimension_page(events: DataFrame, period: TimeRange | None, by: str, metric: str) -> DataFrame:
    """A dimension's report with the share of the chosen metric."""
    check_metric(by, metric)
    build = reports.product_report if dimension(by).group == "product" else reports.dimension_report
    return shares.add_share_pct(shares.add_share(settle(build(events, period, by), "report"), metric))


def dimension_bars(events: DataFrame, period: TimeRange | None, by: str, metric: str,
                   n: int = DEFAULT_ROWS) -> DataFrame:
    """The n largest values of a dimension by metric; shares are of all values."""
    page = dimension_page(events, period, by, metric)
    return shares.top_n(page, metric, n, "dimension").select("dimension", metric, "share", "share_pct")


def heatmap(events: DataFrame, period: TimeRange | None, n: int = DEFAULT_ROWS) -> DataFrame:
    """Day by event counts of the most frequent events."""
    return shares.keep_top_events(settle(reports.day_event_counts(events, period), "report"), n)


def snapshot_events_page(counts: DataFrame) -> DataFrame:
    page = shares.add_share_pct(snapshot.by_event(counts))
    return page.withColumn("avg_per_active_product", round_even(F.col("avg_per_active_product")))


def snapshot_products_page(counts: DataFrame) -> DataFrame:
    return shares.add_share_pct(snapshot.by_product(counts))


def funnel_page(counts: DataFrame) -> DataFrame:
    return shares.add_share_pct(snapshot.funnel(counts))


def purchases_page(counts: DataFrame) -> DataFrame:
    return shares.add_share_pct(snapshot.purchases_by_product(counts))


def pareto_of_events(counts: DataFrame, n: int = DEFAULT_ROWS) -> DataFrame:
    return shares.pareto(snapshot.by_event(counts), "event_name", "count", shares.pareto_size(n))


def pareto_of_products(counts: DataFrame, n: int = DEFAULT_ROWS) -> DataFrame:
    return shares.pareto(snapshot.by_product(counts), "product_id", "count", shares.pareto_size(n))


def busiest_product_page(counts: DataFrame) -> DataFrame:
    """Drilldown into the most active product, the one offered first."""
    first = snapshot.drilldown_candidates(counts, 1).select("product_id").scalar()
    return shares.add_share_pct(snapshot.drilldown(counts, first))


def comparison(events: DataFrame, period: TimeRange | None, counts: DataFrame) -> DataFrame:
    """Batch counts of a period and the running counts, per event and unrounded."""
    batch = combined.batch_event_counts(reports.event_counts(events, period))
    return combined.compare(batch, combined.realtime_event_counts(counts))
