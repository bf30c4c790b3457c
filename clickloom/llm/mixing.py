"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each seat is a block of words. Seats go to the sources with the highest quotients target / (2k + 1); as the
method is house monotone, the quotas of a shard are the differences between two house sizes. Each source's documents stand in
a seeded order, its words cut into blocks, and the shards take its next blocks in turn; a source that gives
more than it has starts over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import KEY, SPACE, different_rows, row_key, settle

SEED = 40_009
#: Share of all words that the mix takes, and how often a document may be taken.
TOTAL = 1.5
MOST = 2.0
#: Weights of the sources in code point order, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words in a block: targets are met to about one block.
BLOCK = 8
SHARDS = 8
#: Documents of a source that are put in order together, on average.
BIN_ROWS = 4096


def word_count(text: Column) -> Column:
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SPACE}]+", "x")
    return F.length(F.translate(marks, " \t\n\u000b\f\r", "")).cast("long")


def targets(sizes: DataFrame, total: float = TOTAL, most: float = MOST,
            weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size, rows, target)`` from one row per source.

    Targets share ``total`` of all words by weight and stop at ``most`` times the source's words; the excess
    is shared by weight again. The sources that stop are those with the least cap per weight, so
    one ordered pass finds the level at which the others stand.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(w) for w in weights])
    cap = F.col("source_size") * F.lit(most)
    ranked = sizes.withColumn("_w", F.get(choices, F.pmod(F.row_number().over(by_name) - 1,
                                                          F.lit(len(weights)))))
    order = Window.orderBy(cap / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(total)
              - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    open_ = ranked.withColumn("_level", level).withColumn("_open", F.col("_level") <= cap / F.col("_w"))
    stand = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(everything)
    return open_.withColumn("_stand", stand).select(
        "source", "source_size", "rows",
        F.least(cap, F.coalesce(F.col("_stand") * F.col("_w"), cap)).alias("target"))


def quotas(goals: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """``(source, quota, shard_quotas, shard_seats)``: blocks per source, in all, by shard and up to each shard.

    A divisor a little above and one a little below the average quotient bound every source's seats from both
    sides, as rounding moves the sum by at most half a seat per source. Only the quotients between the bounds
    are ranked: about two for each source, whatever the number of seats.
    """
    everything = Window.partitionBy()
    house = F.ceil(F.sum("target").over(everything) / F.lit(float(block)))
    base = goals.select("source", "target", house.alias("_house"),
                        F.sum("target").over(everything).alias("_all"),
                        F.count(F.lit(1)).over(everything).alias("_sources"))
    houses = base.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "_seats", F.floor(F.col("_house") * (F.col("shard") + 1) / F.lit(shards)))
    half = F.col("_sources") / F.lit(2.0) + 1

    def seats_at(seats: Column) -> Column:
        return F.when(seats > 0, F.floor(F.col("target") * seats / F.col("_all") + 0.5)).otherwise(0)

    bounded = houses.withColumns({
        "_sure": F.when(F.col("_all") > 0, seats_at(F.col("_seats") - half)).otherwise(0).cast("long"),
        "_can": F.when(F.col("_all") > 0, seats_at(F.col("_seats") + half)).otherwise(0).cast("long")})
    tried = bounded.select(
        "shard", "source", "target", "_seats", "_sure",
        F.explode(F.sequence(F.col("_sure"), F.col("_can"))).alias("_k"))
    highest = Window.partitionBy("shard").orderBy(
        F.col("_quotient").desc(), F.col("source").asc_nulls_last())
    left = F.col("_seats") - F.col("_all_sure")
    won = (tried.withColumn("_quotient", F.col("target") / (2 * F.col("_k") + 1))
           .withColumn("_all_sure", F.sum(F.when(F.col("_k") == F.col("_sure"), F.col("_sure")))
                       .over(Window.partitionBy("shard")))
           .withColumn("_rank", F.row_number().over(highest))
           .groupBy("source", "shard", "_sure")
           .agg(F.sum(F.when(F.col("_rank") <= left, 1).otherwise(0)).alias("_more"))
           .withColumn("_held", F.col("_sure") + F.col("_more")))
    earlier = F.lag("_held", 1, 0).over(Window.partitionBy("source").orderBy("shard"))
    return (won.withColumn("_own", F.col("_held") - earlier).groupBy("source")
            .agg(F.max("_held").alias("quota"),
                 F.transform(F.sort_array(F.collect_list(F.struct("shard", "_own"))),
                             lambda s: s["_own"]).alias("shard_quotas"),
                 F.transform(F.sort_array(F.collect_list(F.struct("shard", "_held"))),
                             lambda s: s["_held"]).alias("shard_seats")))


def taken(digests: DataFrame, seed: int = SEED, block: int = BLOCK, shards: int = SHARDS,
          **goal: object) -> DataFrame:
    """``digests(doc_id, source, size, text_hash, rows, ...)`` with source_size, target, start and taken.

    One row stands for ``rows`` equal documents, which follow each other in the source's seeded order; ``start`` is the
    word at which the first of them begins, ``reach`` the words that the mix takes from the source and ``shard_reach`` those
    it has taken by the end of each shard. Documents are ordered in bins of a hash range, so that a source with most of the rows is no single group.
    """
    spread = digests.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "source", "text_hash", "size"))
    per_source = settle(spread.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("rows")), "sources")
    goals = targets(per_source, **goal)
    most = F.floor(F.col("source_size") * F.lit(MOST))

    def reached(seats: Column) -> Column:
        return F.least(seats * F.lit(block), most)

    given = goals.join(quotas(goals, shards, block).withColumnRenamed("source", "_s"),
                       F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), "source_size", "target", "shard_quotas",
        F.transform("shard_seats", reached).alias("shard_reach"), reached(F.col("quota")).alias("reach"),
        F.ceil(F.col("rows") / F.lit(BIN_ROWS)).alias("_bins"))
    given = settle(given, "quotas")
    unit = F.pmod(F.col("_hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    placed = spread.join(given, spread["source"].eqNullSafe(given["_s"])).withColumn(
        "_bin", F.floor(unit * F.col("_bins"))).withColumn("_words", F.col("size") * F.col("rows"))
    order = Window.partitionBy("source", "_bin").orderBy(
        F.pmod(F.col("_hash"), F.lit(1 << 30)), "_hash", *KEY).rowsBetween(
        Window.unboundedPreceding, -1)
    bins = spread.join(given, spread["source"].eqNullSafe(given["_s"])).groupBy(
        "source", F.floor(unit * F.col("_bins")).alias("_bin")).agg(
        F.sum(F.col("size") * F.col("rows")).alias("_sum"))
    # Bins of one source: a row for every BIN_ROWS documents.
    ahead = bins.select(F.col("source").alias("_bs"), F.col("_bin").alias("_bb"), F.coalesce(
        F.sum("_sum").over(Window.partitionBy("source").orderBy("_bin")
                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    ordered = placed.withColumn("_in_bin", F.coalesce(F.sum("_words").over(order), F.lit(0)))
    return ordered.join(ahead, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_bin") == F.col("_bb"))).select(
        *digests.columns, "source_size", "target", "shard_quotas", "shard_reach", "reach",
        (F.col("_ahead") + F.col("_in_bin")).alias("start"))


def words_taken(start: Column, reach: Column | None = None) -> Column:
    """Words of one document from ``start`` that lie below ``reach``, each pass through the source counted."""
    reach = F.col("reach") if reach is None else reach
    passes = F.when(F.col("source_size") > 0, F.floor(reach / F.col("source_size"))).otherwise(0)
    rest = reach - passes * F.col("source_size")
    return (passes * F.col("size")
            + F.least(F.col("size"), F.greatest(F.lit(0), rest - start))).cast("long")


def words_by_shard(start: Column) -> Column:
    """Words of one document that each shard takes, as an array: a shard's blocks are the source's next ones."""
    below = F.transform("shard_reach", lambda reach: words_taken(start, reach))
    return F.transform(below, lambda words, i: words - F.when(i > 0, F.get(below, i - 1)).otherwise(0))


def digests_of(docs: DataFrame) -> DataFrame:
    """Equal rows as one: their key, doc_id, source, size, text_hash and how many rows."""
    return docs.select(*row_key(docs), "doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("text_hash")).groupBy(
        *KEY, "doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and shard_words, what each shard takes of it.

    Each shard takes its quota of the source's blocks, whose order the seed decides, up to ``MOST`` times the source.
    Null texts and texts without words have size 0 and nothing is taken of them. A null source is a source, the
    last one. An empty table gives an empty one. Other columns are not looked at.
    """
    counted = settle(digests_of(docs.select("doc_id", "source", "text")), "digests")
    each = taken(counted, **options).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    start = F.col("start") + (F.col("_copy") - 1) * F.col("size")
    return each.select("doc_id", "size", "source_size", "target", words_taken(start).alias("taken"),
                       words_by_shard(start).alias("shard_words"))


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix as whole documents with the columns of ``docs``: each as often as its words are taken, to the
    nearest whole copy. Documents without words stay once."""
    counted = settle(digests_of(docs), "digests")
    size, copies = F.col("size") * F.col("rows"), F.col("rows")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("reach") / F.col("source_size"))).otherwise(0)
    rest = F.col("reach") - passes * F.col("source_size") - F.col("start")
    part = F.least(size, F.greatest(F.lit(0), rest)) / F.col("size")
    times = F.when(F.col("size") > 0, passes * copies + F.floor(part + 0.5)).otherwise(copies)
    wanted = taken(counted, **options).select(*KEY, times.cast("int").alias("_times")).filter("_times > 0")
    return different_rows(docs).join(wanted, KEY).select("_doc", F.explode(
        F.sequence(F.lit(1), F.col("_times")))).select("_doc.*")
