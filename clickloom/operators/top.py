"""The commonest values of a dimension too large to count value by value.

Values are dealt to a bounded number of hash buckets, and a bucket's total bounds the count of each value in it from above.
Only values of the heaviest buckets are counted one by one. If the last value shown counts more than any bucket left out
holds, none can have been missed; otherwise every value is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that values are dealt to, and heavy buckets looked into for each value wanted.
BUCKETS = 1 << 20
HEAVY = 4


def top_values(rows: DataFrame, value: Column, n: int, buckets: int = BUCKETS, heavy: int = HEAVY) -> DataFrame:
    """``value, count`` of the ``n`` commonest non-null values, ties by value; exact.

    The driver gets ``heavy * n + 1`` bucket totals and the ``n``-th count, never values.
    """
    named = rows.select(value.alias("value")).filter(F.col("value").isNotNull())
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    totals = named.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("total"))
    found = totals.orderBy(F.desc("total"), "bucket").limit(heavy * n + 1).collect()
    if len(found) <= heavy * n:
        return _counted(named, n)
    candidates = _counted(named.filter(bucket.isin([r["bucket"] for r in found[:-1]])), n)
    counts = [r["count"] for r in candidates.select("count").collect()]  # n rows
    return candidates if len(counts) == n and counts[-1] > found[-1]["total"] else _counted(named, n)


def _counted(named: DataFrame, n: int) -> DataFrame:
    return named.groupBy("value").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value").limit(n)
