"""Two-pass external shuffle: scatter into memory-sized buckets, then Fisher-Yates in each bucket.

Pass 1 folds equal rows, found by a hash of the whole row, and scatters them by a seeded hash of that and of their
number among the equal ones, which spreads a document however often it is repeated. Pass 2 gathers one bucket at a time
(its size is bounded by ``bucket_bytes``), puts it into a fixed order and applies Spark's ``shuffle``, an inside-out
Fisher-Yates with a seeded generator. Rows are then dealt to the shards in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import KEY, row_key, settle

SEED = 20_011
#: Text bytes gathered into one bucket on average.
BUCKET_BYTES = 16 << 20
#: Buckets there are at least, so that small tables are spread as well.
LEAST_BUCKETS = 64
#: Text bytes that one task gathers, bucket by bucket, on average.
PART_BYTES = 256 << 20
#: Copies of one row that one task makes.
AT_ONCE = 4096
#: Buckets whose offsets (16 bytes each) are broadcast; more are joined as Spark chooses.
MOST_OFFSETS = 1 << 18


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus one for the line's end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _copies(folded: DataFrame) -> DataFrame:
    """Each row as often as ``_n`` says, numbered by ``_copy``. Those of a row repeated more than ``AT_ONCE`` times are
    made in several tasks."""
    first = F.col("_turn") * AT_ONCE + 1
    many = (folded.filter(F.col("_n") > AT_ONCE)
            .withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / AT_ONCE))))
            .repartition(*KEY, "_turn")
            .withColumn("_copy", F.explode(F.sequence(first, F.least(F.col("_n"), first + AT_ONCE - 1)))).drop("_turn"))
    few = folded.filter(F.col("_n") <= AT_ONCE).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    return few.unionByName(many)


def external_shuffle(docs: DataFrame, size: str, shards: int, seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0).

    The law is "rows": shards hold equally many rows, or one more. ``size`` names a column with the row's
    bytes (null counts as 0). Columns called shard or slot are replaced. An
    empty table stays empty; nulls and repeated rows are rows like any other. The same rows get the same places, however they
    are split into files and whatever the session's number of partitions.
    """
    docs = docs.drop("shard", "slot")
    number = F.count(F.lit(1)).alias("_n")
    known = settle(docs.select(*row_key(docs), F.col(size).cast("long").alias("_size")).groupBy(*KEY).agg(
        number, F.first("_size").alias("_size")), "keys")
    total = known.agg(F.sum(F.col("_n") * F.col("_size"))).first()[0] or 0  # one number
    buckets = max(LEAST_BUCKETS, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *KEY, "_copy"), F.lit(buckets)).cast("int").alias("_bucket")
    folded = docs.select(*row_key(docs), F.struct("*").alias("_doc")).groupBy(*KEY).agg(number, F.first("_doc").alias("_doc"))
    row = F.struct(*KEY, "_copy", "_doc")
    counts = _copies(known).groupBy(bucket).agg(number)
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    # A number of partitions that follows from the rows, sorted by bucket: the generator's state depends on nothing else.
    parts = max(LEAST_BUCKETS, -(-total // part_bytes))
    gathered = (_copies(folded).select(bucket, row.alias("_row")).repartition(parts, "_bucket").groupBy("_bucket")
                .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
                .sortWithinPartitions("_bucket"))
    shuffled = gathered.select("_bucket", F.posexplode(F.shuffle("_rows", seed)).alias("_at", "_it"))
    place = F.col("_offset") + F.col("_at")
    return shuffled.join(F.broadcast(offsets) if buckets <= MOST_OFFSETS else offsets, "_bucket").select(
        "_it._doc.*", F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.floor(place / F.lit(shards)).cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Writes the result of ``external_shuffle`` as one folder per shard, rows in slot order."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
