"""Batch results next to the running counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.scalars import lenient_double, lenient_long, round_even
from clickloom.operators.shares import add_share, layers, top_n_by_max

# The columns looked for in a result, first match wins.
COUNT_COLUMNS = ("events", "cnt", "count")
TOTAL_COLUMNS = ("cnt", "count", "counts", "events", "orders", "revenue_usd", "total_sales_usd",
                 "units_sold")
SERIES_COLUMNS = ("event_name", "dimension", "product_id", "time_bucket", "hour_of_day")


def batch_event_counts(result: DataFrame) -> DataFrame:
    """``event_name, batch_cnt, batch_share`` of any result with a count per event; no rows if the
    result has none."""
    value = next((c for c in COUNT_COLUMNS if c in result.columns), None)
    if value is None or "event_name" not in result.columns:
        return result.sparkSession.createDataFrame(
            [], "event_name STRING, batch_cnt BIGINT, batch_share DOUBLE")
    counts = (
        result.filter(F.col("event_name").isNotNull()).groupBy("event_name")
        .agg(F.sum(value).alias("batch_cnt"))
    )
    return add_share(counts, "batch_cnt", "batch_share")


def realtime_event_counts(snapshot: DataFrame) -> DataFrame:
    counts = (
        snapshot.filter(F.col("event_name").isNotNull()).groupBy("event_name")
        .agg(F.sum(lenient_long(F.col("count"))).alias("realtime_cnt"))
    )
    return add_share(counts, "realtime_cnt", "realtime_share")


def result_kpis(result: DataFrame) -> DataFrame:
    """One row about any result: rows, total of its first count-like column (whole number), number
    of series and the largest row's share."""
    total_column = next((c for c in result.columns if c.lower() in TOTAL_COLUMNS), None)
    series_column = next((c for c in SERIES_COLUMNS if c in result.columns), None)
    total: Column = F.lit(0).cast("bigint")
    largest: Column = F.lit(0.0)
    if total_column:
        number = lenient_double(F.col(total_column))
        total = F.coalesce(F.sum(number), F.lit(0.0)).cast("bigint")
        largest = F.coalesce(
            F.when(F.sum(number) > 0, F.max(number) / F.sum(number)), F.lit(0.0))
    series = F.countDistinct(series_column) if series_column else F.lit(0).cast("bigint")
    return result.agg(
        F.count("*").alias("rows"), total.alias("total"), series.alias("series"),
        largest.alias("top_share"))


def compare(batch: DataFrame, realtime: DataFrame) -> DataFrame:
    """Both layers per event, unrounded. Both inputs are grouped by event, a few rows each."""
    both = batch.join(realtime, "event_name", "full_outer")
    filled = both.select(
        "event_name",
        lenient_long(F.col("batch_cnt")).alias("batch_cnt"),
        lenient_long(F.col("realtime_cnt")).alias("realtime_cnt"),
        lenient_double(F.col("batch_share")).alias("batch_share"),
        lenient_double(F.col("realtime_share")).alias("realtime_share"),
    )
    return filled.withColumns({
        "delta_speed_minus_batch": F.col("realtime_cnt") - F.col("batch_cnt"),
        "share_delta_pp": (F.col("realtime_share") - F.col("batch_share")) * 100.0,
    })


def combined_view(batch_result: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Batch against running counts per event, largest gain in share first."""
    both = compare(batch_event_counts(batch_result), realtime_event_counts(snapshot))
    return both.orderBy(F.desc("share_delta_pp"), "event_name").select(
        "event_name", "batch_cnt", "realtime_cnt", "delta_speed_minus_batch",
        round_even(F.col("batch_share") * 100.0).alias("batch_share_pct"),
        round_even(F.col("realtime_share") * 100.0).alias("realtime_share_pct"),
        round_even(F.col("share_delta_pp")).alias("share_delta_pp"),
    )


def combined_totals(compared: DataFrame) -> DataFrame:
    """One row: both totals and both purchase shares."""
    def purchase(share: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("event_name") == "purchase", F.col(share))), F.lit(0.0)).alias(
                share.replace("share", "purchase_share"))

    return compared.agg(
        F.coalesce(F.sum("batch_cnt"), F.lit(0)).alias("batch_events"),
        F.coalesce(F.sum("realtime_cnt"), F.lit(0)).alias("realtime_events"),
        purchase("batch_share"), purchase("realtime_share"),
    )


def combined_long(compared: DataFrame, n: int) -> DataFrame:
    """The n busiest events, one row per layer."""
    busiest = top_n_by_max(compared, "batch_cnt", "realtime_cnt", n, "event_name")
    return layers(busiest.select("event_name", "batch_cnt", "realtime_cnt"), "event_name",
                  "batch_cnt", "realtime_cnt")
