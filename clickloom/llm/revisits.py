"""Not-modified revisits resolved to the latest earlier full response of the same canonical URL.

Records are laid out in ranges of (URL, time), so that a URL with a third of all records spans many partitions. Within
a range a window carries the last full response on; what begins in an earlier range comes from a table with one
row per range and URL. No URL is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import ascii_lower, settle

# Header fields that a 304 may not change, as they describe the stored body or the connection.
KEPT_HEADERS = ("content-length", "content-encoding", "content-type", "content-range", "transfer-encoding",
                "connection", "keep-alive", "trailer", "upgrade", "proxy-authenticate")
#: Query parameters that do not choose the content.
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref)="


def canonical(url: Column) -> Column:
    """Without scheme, fragment, default port, tracking parameters and closing slashes; host in lower case and
    parameters in order. A url without ``://`` stands as it is; null stays null."""
    bare = F.regexp_replace(url, "(?s)#.*$", "")
    rest = F.regexp_replace(bare, "(?s)^.*?://", "")
    host = F.regexp_replace(ascii_lower(F.regexp_extract(rest, "^[^/?]*", 0)), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "(?s)^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "(?s)^[^?]*\\?(.*)$", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    whole = F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&")))
                     .otherwise(""))
    return F.when(F.contains(bare, F.lit("://")), whole).otherwise(bare)


def _lower_keys(headers: Column) -> Column:
    """Names in lower case; of names that differ by case only, the first stays."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key: string, value: string>>"))
    lower = F.transform(entries, lambda e: F.struct(ascii_lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.filter(lower, lambda e, i: ~F.exists(
        F.slice(lower, 1, i), lambda x: x["key"] == e["key"])))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records(record_id, url, fetched, kind, headers, digest)``.

    Columns: record_id, canonical_url, outcome, target_id, digest and headers. Of the full responses (kind
    "response") of the canonical URL that came earlier, or at the same time with a lesser record_id, the latest counts, of repeated ones that of the greater
    digest. Outcome is
    ``resolved`` if the revisit's ETag (weak comparison), or without one its Last-Modified, equals that response's;
    ``unvalidated`` if the revisit names neither; ``mismatch`` if they differ; ``missing`` without an earlier response.
    Only a resolved revisit gets a target, its digest and the merged headers: the response's, updated by
    the revisit's except those that describe the body. A null URL or time never resolves. Repeated records
    each give a row.
    """
    rows = records.select("record_id", canonical(F.col("url")).alias("canonical_url"), "fetched", "kind",
                          _lower_keys(F.col("headers")).alias("headers"), "digest")
    # A revisit stands before a response of its own record_id and time.
    order = ["canonical_url", "fetched", "record_id", F.col("kind").desc_nulls_first(), "digest"]
    rows = settle(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "records")
    full = (F.col("kind") == "response") & F.col("fetched").isNotNull() & F.col("canonical_url").isNotNull()
    response = F.when(full, F.struct("record_id", "headers", "digest"))
    time = [F.col("fetched").asc_nulls_last(), *order[2:]]
    inside = Window.partitionBy("_range", "canonical_url").orderBy(*time).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("_own", F.last(response, ignorenulls=True).over(inside)).filter("kind = 'revisit'")
    closing = rows.filter(full).groupBy("_range", "canonical_url").agg(
        F.max_by(F.struct("record_id", "headers", "digest"), F.struct("fetched", "record_id", "digest")).alias("_closing"))
    # One row per range and URL, ranges without a response included where they hold revisits.
    spans = rows.groupBy("_range", "canonical_url").agg(F.count(F.lit(1)).alias("_n")).join(
        closing, ["_range", "canonical_url"], "left")
    earlier = Window.partitionBy("canonical_url").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("_range", "canonical_url",
                           F.last("_closing", ignorenulls=True).over(earlier).alias("_carried"))
    found = seen.join(carried.filter("_carried is not null"), ["_range", "canonical_url"], "left").withColumn(
        "_at", F.when(F.col("fetched").isNotNull(), F.coalesce("_own", "_carried")))
    mine, theirs = F.col("headers"), F.col("_at.headers")
    etag, stamp = F.element_at(mine, "etag"), F.element_at(mine, "last-modified")
    same = F.when(etag.isNotNull(), F.coalesce(_weak(etag) == _weak(F.element_at(theirs, "etag")), F.lit(False))).otherwise(
        F.coalesce(stamp == F.element_at(theirs, "last-modified"), F.lit(False)))
    outcome = (F.when(F.col("_at").isNull(), "missing").when(etag.isNull() & stamp.isNull(), "unvalidated")
               .when(same, "resolved").otherwise("mismatch"))
    permitted = F.map_filter(mine, lambda k, v: ~k.isin(*KEPT_HEADERS))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)
    good = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "outcome", F.when(good, F.col("_at.record_id")).alias("target_id"),
        F.when(good, F.col("_at.digest")).alias("digest"), F.when(good, merged).alias("headers"))
