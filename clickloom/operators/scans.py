"""Looking back over a key's rows without gathering a busy key in one task.

A plain window over ``partitionBy(key)`` hands all rows of a key to one task. Here the rows are laid out in ranges of
(key, order) instead and written once, so that Spark cuts them by number of rows: a key with a large part of
the table spans many ranges, even if all its rows are of one second. A range is scanned on its own, and what came
before it is taken from a table of one row per key and range. All keys take the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import settle

CHUNK = "__chunk"


def laid_out(df: DataFrame, key: str, order: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of (key, order), with the number of each row's range.

    ``ranges`` is the number of ranges; by default that of shuffle partitions.
    """
    columns = [key, *order]
    spread = df.repartitionByRange(ranges, *columns) if ranges else df.repartitionByRange(*columns)
    return settle(spread.withColumn(CHUNK, F.spark_partition_id()), "ranges")


def crossing(rows: DataFrame, key: str) -> DataFrame:
    """The keys that lie in more than one range: at most as many as there are ranges."""
    return rows.groupBy(key, CHUNK).agg(F.lit(1).alias("__one")).groupBy(key).agg(
        F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(key)


def last_before(df: DataFrame, key: str, order: list[str], name: str, value: Column,
                ranges: int | None = None) -> DataFrame:
    """Add the last non-null value among the key's earlier rows, null if there is none.

    ``order`` orders a key's rows completely, nulls first. Keys must not be null.
    """
    rows = laid_out(df.withColumn("__value", value), key, order, ranges)
    earlier_rows = (
        Window.partitionBy(key, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumn("__within", F.last("__value", True).over(earlier_rows))

    last_of_chunk = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order)))
    earlier_chunks = (
        Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = rows.groupBy(key, CHUNK).agg(last_of_chunk.alias("__last"))
    starts = chunks.select(key, CHUNK, F.last("__last", True).over(earlier_chunks).alias("__before"))
    return (
        local.join(starts.filter(F.col("__before").isNotNull()), [key, CHUNK], "left")
        .withColumn(name, F.coalesce("__within", "__before"))
        .drop("__value", CHUNK, "__within", "__before")
    )
