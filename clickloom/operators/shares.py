"""Shares, Pareto tables, top-N, funnels and reshaping.

Totals come in as scalar subqueries: one number per query, no join and no window over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.scalars import lenient_double, share_pct
from clickloom.schemas import FUNNEL_STAGES


def _number(df: DataFrame, value: str) -> Column:
    """The column as a number; values that are none count as 0."""
    if dict(df.dtypes)[value] == "string":
        return lenient_double(F.col(value))
    if dict(df.dtypes)[value] in ("double", "float"):
        return lenient_double(F.col(value))
    return F.coalesce(F.col(value), F.lit(0))


def add_share(df: DataFrame, value: str, share: str = "share") -> DataFrame:
    """Share of the whole frame's total; 0.0 when there is no positive total."""
    number = _number(df, value)
    total = df.agg(F.sum(number)).scalar()
    return df.withColumn(share, F.when(total > 0, number / total).otherwise(F.lit(0.0)))


def add_share_pct(df: DataFrame, share: str = "share") -> DataFrame:
    return df.withColumn("share_pct", share_pct(F.col(share)))


def top_share(df: DataFrame, value: str) -> DataFrame:
    """One row: the largest value's share of the total."""
    number = _number(df, value)
    total = F.sum(number)
    return df.agg(F.when(total > 0, F.max(number) / total).otherwise(F.lit(0.0)).alias("top_share"))


def top_n_share(df: DataFrame, value: str, n: int) -> DataFrame:
    """One row: the share of the n largest values."""
    number = _number(df, value)
    total = df.agg(F.sum(number)).scalar()
    largest = df.select(number.alias("v")).orderBy(F.desc("v")).limit(n)
    return largest.agg(
        F.coalesce(F.when(F.max(total) > 0, F.sum("v") / F.max(total)), F.lit(0.0)).alias("top_share"))


def top_n(df: DataFrame, value: str, n: int, key: str) -> DataFrame:
    """The n rows with the largest value, ties by key."""
    return df.orderBy(F.desc(value), key).limit(n)


def top_n_by_max(df: DataFrame, first: str, second: str, n: int, key: str) -> DataFrame:
    """The n rows whose larger one of two columns is largest."""
    return df.orderBy(F.desc(F.greatest(first, second)), key).limit(n)


# The bounds of Pareto tables and heatmaps.
def pareto_size(n: int) -> int:
    """Rows of a Pareto table for a page showing n."""
    return min(30, max(10, n))


def pareto(df: DataFrame, category: str, value: str, n: int) -> DataFrame:
    """The n largest categories with running totals; percentages are of those n, and there are no
    rows without a positive total."""
    number = _number(df, value)
    largest = df.select(category, number.alias(value)).orderBy(F.desc(value), category).limit(n)
    # At most n rows are left, so ordering them in one task is fine.
    running = Window.orderBy(F.desc(value), category).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc(value), category).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        largest.withColumn("cumulative", F.sum(value).over(running))
        .withColumn("total", F.sum(value).over(whole))
        .filter(F.col("total") > 0)
        .withColumn("cumulative_pct", F.col("cumulative") / F.col("total") * 100.0)
        .drop("total")
    )


def funnel_stages(df: DataFrame) -> DataFrame:
    """The fixed stages, ``pos, event_name``, in the session of df."""
    rows = ", ".join(f"({i}, '{stage}')" for i, stage in enumerate(FUNNEL_STAGES, 1))
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS stages(pos, event_name)")


def on_funnel(counts: DataFrame, value: str) -> DataFrame:
    """Counts per event laid onto the fixed stages in order; stages without events are 0."""
    stages = funnel_stages(counts)
    return (
        # The stages are a handful of fixed rows; the counts hold a row per event name.
        stages.join(counts.select("event_name", value), "event_name", "left")
        .select("pos", "event_name", F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias("count"))
        .orderBy("pos")
    )


def lookup_sum(df: DataFrame, key: str, wanted: str, value: str) -> DataFrame:
    """One row: the sum of a key's values, 0.0 if it does not occur."""
    hit = F.when(F.col(key) == wanted, _number(df, value))
    return df.agg(F.coalesce(F.sum(hit).cast("double"), F.lit(0.0)).alias("value"))


def heatmap_size(n: int) -> int:
    """Events shown in a heatmap on a page showing n."""
    return min(15, max(8, n))


def keep_top_events(counts: DataFrame, n: int, value: str = "cnt") -> DataFrame:
    """Rows of the most frequent events of a day-by-event table."""
    totals = counts.filter(F.col("event_name").isNotNull()).groupBy("event_name").agg(F.sum(value).alias("total"))
    top = totals.orderBy(F.desc("total"), "event_name").limit(heatmap_size(n)).select("event_name")
    return counts.join(top, "event_name", "left_semi")


def heatmap_matrix(counts: DataFrame, row: str, column: str, value: str,
                   columns: tuple[str, ...] | None = None) -> DataFrame:
    """Long to wide: one column per value present, or listed, summed, 0 where there is none.

    More than ``spark.sql.pivotMaxValues`` values are refused. Null is no column; a row that has nothing else is all 0.
    """
    if columns is None:
        most = int(counts.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = counts.filter(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} values (spark.sql.pivotMaxValues)")
        columns = tuple(sorted(r[0] for r in found))
    if not columns:
        return counts.select(row).distinct()
    return counts.groupBy(row).pivot(column, list(columns)).agg(F.sum(value)).na.fill(0)


def layers(df: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Wide to long: ``key, layer, value`` from two columns."""
    return df.unpivot(key, [first, second], "layer", "value")
