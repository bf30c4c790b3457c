"""State folders by hash bucket of a key, so that a batch reads only the buckets of its own keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a state folder; a folder keeps the number it was begun with.
BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_in(rows: DataFrame, key: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets that hold keys of ``rows``: as many numbers as there are buckets, at most."""
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def write_buckets(rows: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """``rows`` below ``bucket=B``, few files a bucket; Spark splits a bucket that is too big for one task."""
    rows.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy(
        "bucket").parquet(path)
