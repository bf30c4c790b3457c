"""Line dedup: lines that many documents share are dropped, by way of a keep bitmap per document.

Every line is a row (hash of its key, document, position). The rows are laid out in ranges of hash and document and
sorted by position within them, so a line with a third of all rows spans many ranges. Streaming over a range marks the first
occurrence of a line in each document; a line's documents are the sum of those marks over the ranges it spans. The
lines that go come back as one bitmap per document, so the texts take no part in any of this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import KEY, ascii_lower, row_key, settle

#: Characters stripped at both ends of a line.
STRIPPED = " \t\n\u000b\f\r"
#: Documents that share a line before it goes, and code points that its key has at least.
DOCUMENTS = 10
LEAST_CHARS = 1

HASH = ["_h1", "_h2"]
DOC = ["doc_id", KEY[0]]


def lines_of(text: Column) -> Column:
    """The text split at line feeds; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(STRIPPED))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the part of their row hash that tells documents of one doc_id apart."""
    return docs.select("*", row_key(docs)[0])


def occurrences(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Ranges of line occurrences: hash, document, position, whether it is the document's first, and the range.

    Copies of a whole row share their key; the first line of each copy counts.
    """
    lines = docs.select(*DOC, F.posexplode(lines_of(F.col("text"))).alias("_at", "_line"))
    key = line_key(F.col("_line"))
    hashed = lines.filter(F.length(key) >= least_chars).select(
        *[F.xxhash64(F.lit(i), key).alias(name) for i, name in enumerate(HASH)], *DOC, "_at")
    # Written before the ranges, whose bounds take a look at all rows first.
    hashed = settle(hashed, "hashes")
    ranged = hashed.repartitionByRange(*HASH, *DOC).sortWithinPartitions(*HASH, *DOC, "_at")
    # The ranges already hold the rows of a line and document together: no further shuffle.
    earlier = F.rank().over(Window.partitionBy(*HASH, *DOC).orderBy("_at"))
    return settle(ranged.select("*", (earlier == 1).alias("_first"), F.spark_partition_id().alias("_range")), "lines")


def keep_bitmaps(docs: DataFrame, documents: int = DOCUMENTS, least_chars: int = LEAST_CHARS,
                 keep_first: bool = False) -> DataFrame:
    """``doc_id, _key1, keep, n_dropped`` for every document that loses lines; ``docs`` is ``keyed``.

    A line goes if its key has ``least_chars`` code points or more and stands in ``documents`` rows or more.
    With ``keep_first`` its first occurrence, by doc_id (null first), row hash and position, stays. ``keep`` has a bit
    for each line, lowest first in each long, set if the line stays; longs after the last line that goes are left out.
    Equal rows have one bitmap, and each counts as a document.
    """
    rows = occurrences(docs, least_chars)
    place = F.struct(*DOC, "_at")
    shared = rows.groupBy(*HASH).agg(
        F.sum(F.col("_first").cast("long")).alias("_documents"), F.min("_range").alias("_from"),
        F.max("_range").alias("_to"), *([F.min(place).alias("_place")] if keep_first else []))
    # Joined by range as well, so that a very common line meets its rows in as many tasks as it has ranges.
    going = shared.filter(F.col("_documents") >= documents).withColumn(
        "_range", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to", "_documents")
    gone = rows.join(going, [*HASH, "_range"])
    if keep_first:
        gone = gone.filter(place != F.col("_place"))
    words = gone.groupBy(*DOC, F.expr("_at div 64").cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _at % 64)")).alias("_bits"))
    listed = words.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_words"),
        F.sum(F.bit_count("_bits")).cast("long").alias("n_dropped"))
    # Words without a line that goes are filled in.
    keep = F.expr("""flatten(transform(_words, (x, i) -> concat(
        array_repeat(-1L, x._word - coalesce(get(_words, i - 1)._word, -1) - 1), array(~x._bits))))""")
    return listed.select(*DOC, keep.alias("keep"), "n_dropped")


def kept_lines() -> Column:
    """The lines of ``text`` whose bit in ``_keep`` is set, joined again."""
    return F.expr("""array_join(filter(split(coalesce(text, ''), '\\n'), (line, i) ->
        coalesce(shiftrightunsigned(get(_keep, cast(i div 64 as int)), i % 64) & 1L, 1L) = 1L), '\\n')""")


def without_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``keep`` and ``text`` without the lines that many documents share.

    Null and empty texts have one empty line, which stays; a text that loses all lines is empty. Columns of the new
    names are replaced. An empty table gives an empty one. ``options`` are those of ``keep_bitmaps``.
    """
    docs = keyed(docs.drop("n_lines", "n_dropped", "keep"))
    maps = keep_bitmaps(docs, **options).select(
        F.col("doc_id").alias("_id"), F.col(KEY[0]).alias("_key"), F.col("keep").alias("_keep"),
        F.col("n_dropped").alias("_dropped"))
    found = docs.join(maps, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(KEY[0]) == F.col("_key")), "left")
    text = F.when(F.col("_keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept_lines())
    return found.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in docs.columns if c != KEY[0]],
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.col("_keep").alias("keep"))
