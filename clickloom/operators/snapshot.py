"""Analytics of the running-count snapshot: ``product_id, event_name, count`` rows.

Groups without a key are left out, as null keys form no group here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.scalars import lenient_long, safe_ratio
from clickloom.operators.shares import add_share, on_funnel, top_n_share, top_share


def _counted(snapshot: DataFrame) -> DataFrame:
    return snapshot.withColumn("count", lenient_long(F.col("count")))


def by_event(snapshot: DataFrame) -> DataFrame:
    grouped = (
        _counted(snapshot).filter(F.col("event_name").isNotNull()).groupBy("event_name")
        .agg(F.sum("count").alias("count"), F.countDistinct("product_id").alias("active_products"))
    )
    return (
        add_share(grouped, "count")
        .withColumn("avg_per_active_product", safe_ratio(F.col("count"), F.col("active_products")))
        .orderBy(F.desc("count"), "event_name")
    )


def by_product(snapshot: DataFrame) -> DataFrame:
    return add_share(_product_counts(snapshot), "count").orderBy(F.desc("count"), "product_id")


def _product_counts(snapshot: DataFrame) -> DataFrame:
    return (
        _counted(snapshot).filter(F.col("product_id").isNotNull()).groupBy("product_id")
        .agg(F.sum("count").alias("count"), F.countDistinct("event_name").alias("event_types"))
    )


def mix_matrix(snapshot: DataFrame) -> DataFrame:
    return (
        _counted(snapshot)
        .filter(F.col("product_id").isNotNull() & F.col("event_name").isNotNull())
        .groupBy("product_id", "event_name").agg(F.sum("count").alias("count"))
    )


def _event_counts(snapshot: DataFrame) -> DataFrame:
    return (
        _counted(snapshot).filter(F.col("event_name").isNotNull()).groupBy("event_name")
        .agg(F.sum("count").alias("count"))
    )


def funnel(snapshot: DataFrame) -> DataFrame:
    """The fixed stages with counts and their share among the stages."""
    return add_share(on_funnel(_event_counts(snapshot), "count"), "count").orderBy("pos")


def funnel_ratios(snapshot: DataFrame) -> DataFrame:
    """One row of stage-to-stage ratios and the purchases' part of the funnel."""
    stages = on_funnel(_event_counts(snapshot), "count")

    def count_of(name: str) -> Column:
        return F.sum(F.when(F.col("event_name") == name, F.col("count")).otherwise(0))

    return stages.agg(
        safe_ratio(count_of("add_to_cart"), count_of("product_view")).alias("view_to_cart"),
        safe_ratio(count_of("begin_checkout"), count_of("add_to_cart")).alias("cart_to_checkout"),
        safe_ratio(count_of("purchase"), count_of("begin_checkout")).alias("checkout_to_purchase"),
        safe_ratio(count_of("purchase"), F.sum("count")).alias("purchase_of_total"),
    )


def purchases_by_product(snapshot: DataFrame) -> DataFrame:
    bought = (
        _counted(snapshot)
        .filter((F.col("event_name") == "purchase") & F.col("product_id").isNotNull())
        .groupBy("product_id").agg(F.sum("count").alias("purchase_count"))
    )
    return add_share(bought, "purchase_count").orderBy(F.desc("purchase_count"), "product_id")


def kpis(snapshot: DataFrame) -> DataFrame:
    """One row of twelve figures, all 0 for an empty snapshot.

    Everything is taken from the two grouped tables; the snapshot itself is not ranked.
    """
    rows = _counted(snapshot)
    events = _event_counts(snapshot)
    products = _product_counts(snapshot).select("product_id", "count")

    def count_of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("event_name") == name, F.col("count"))), F.lit(0))

    figures = rows.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_interactions"),
        F.countDistinct("product_id").alias("active_products"),
        F.countDistinct("event_name").alias("event_types"),
        count_of("product_view").alias("views"),
        count_of("add_to_cart").alias("carts"),
        count_of("begin_checkout").alias("checkouts"),
        count_of("purchase").alias("purchases"),
    )
    per_product = safe_ratio(F.col("total_interactions"), F.col("active_products"))
    return figures.select(
        "total_interactions",
        "active_products",
        "event_types",
        per_product.cast("bigint").alias("avg_per_product"),
        top_share(products, "count").scalar().alias("top_product_share"),
        top_n_share(products, "count", 5).scalar().alias("top5_product_share"),
        top_share(events, "count").scalar().alias("top_event_share"),
        top_n_share(events, "count", 3).scalar().alias("top3_event_share"),
        safe_ratio(F.col("purchases"), F.col("total_interactions")).alias("purchase_share"),
        safe_ratio(F.col("carts"), F.col("views")).alias("view_to_cart"),
        safe_ratio(F.col("checkouts"), F.col("carts")).alias("cart_to_checkout"),
        safe_ratio(F.col("purchases"), F.col("checkouts")).alias("checkout_to_purchase"),
    )


def drilldown_candidates(snapshot: DataFrame, n: int = 200) -> DataFrame:
    """Products offered for the drilldown: the n most active."""
    return (
        _product_counts(snapshot).orderBy(F.desc("count"), "product_id").limit(n)
        .select("product_id", "count")
    )


def drilldown(snapshot: DataFrame, product_id: str | Column) -> DataFrame:
    """Event mix of one product, given by id or by a scalar subquery."""
    one = snapshot.filter(F.col("product_id") == product_id)
    return add_share(_event_counts(one), "count").orderBy(F.desc("count"), "event_name")


def drilldown_totals(mix: DataFrame) -> DataFrame:
    """One row: total, distinct event types and the purchases' share of a product's mix."""
    bought = F.coalesce(F.sum(F.when(F.col("event_name") == "purchase", F.col("count"))), F.lit(0))
    total = F.coalesce(F.sum("count"), F.lit(0))
    return mix.agg(
        total.alias("total"), F.countDistinct("event_name").alias("event_types"),
        safe_ratio(bought, total).alias("purchase_share"))
