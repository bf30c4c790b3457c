"""Target-distribution importance resampling on hashed n-grams.

A text is normalised to its words joined by one space and scanned once; the running CRC-32 at each word's end is kept.
The CRC of any run of words follows from two of them: the CRC at the run's start, shifted over the run's bytes
by GF(2) matrices, cancels against the CRC at its end. So no n-gram is ever built as a string. N-grams
are counted per bucket on both sides, a bucket's gain is the logarithm of their ratio, and a document's weight the sum of
its gains. Gumbel noise added to the weights turns the highest scores into a sample without replacement.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import per_text, settle

GRAMS = 3
BUCKETS = 10_000
SEED = 42
#: Share of the documents drawn, in hundredths, and words that a document must have to be drawn.
PERCENT = 5
LEAST_WORDS = 20
#: Words taken through the matrices at once.
AT_ONCE = 1 << 19

# CRC-32 of zip files, reflected.
_POLYNOMIAL = 0xEDB88320
_SEPARATORS = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))
_PIECE = re.compile(rb" [^ ]+")


def _tables(columns: np.ndarray) -> np.ndarray:
    """A GF(2) matrix, given by the images of the 32 bits, as four tables of 256 images of a byte."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.stack([np.bitwise_xor.reduce(np.where(bits == 1, columns[8 * k:8 * k + 8], 0).astype(np.uint32), axis=1)
                     for k in range(4)])


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24])


def _shifts(count: int) -> list[np.ndarray]:
    """Tables of the shifts over 1, 2, 4, ... zero bytes."""
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step = unit
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    found = [_tables(step)]
    while len(found) < count:
        found.append(_tables(_apply(found[-1], _apply(found[-1], unit))))
    return found


_POWERS = _shifts(31)
#: Shifts of up to 255 bytes in one step: by length, the four tables.
_SHORT = np.zeros((256, 4, 256), np.uint32)
_SHORT[0] = _tables(np.uint32(1) << np.arange(32, dtype=np.uint32))
for _n in range(1, 256):
    _low = (_n & -_n).bit_length() - 1
    _SHORT[_n] = _apply(_POWERS[_low], _SHORT[_n & (_n - 1)])
_SHORT = _SHORT.reshape(-1)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved over so many zero bytes."""
    at = (length & 255) << 10
    crc = crc.astype(np.int64)
    moved = (_SHORT[at + (crc & 255)] ^ _SHORT[at + 256 + (crc >> 8 & 255)]
             ^ _SHORT[at + 512 + (crc >> 16 & 255)] ^ _SHORT[at + 768 + (crc >> 24)])
    if len(length) and int(length.max()) > 255:
        for k in range(8, 31):
            here = np.flatnonzero(length >> k & 1)
            if len(here):
                moved[here] = _apply(_POWERS[k], moved[here].astype(np.int64))
    return moved


class Scanned:
    """Texts scanned one after the other: of each word its text, the CRC before and after it, its length."""

    def __init__(self, texts: list[str | None]):
        counts, ends, sizes = [], [], []
        for text in texts:
            words = text.encode("utf-8", "replace").lower().translate(_SEPARATORS).split() if text else []
            counts.append(len(words))
            sizes.extend(map(len, words))
            if words:
                crc = crc32(words[0])
                ends.append(crc)
                for piece in _PIECE.findall(b" ".join(words), len(words[0])):
                    crc = crc32(piece, crc)
                    ends.append(crc)
        self.counts = np.array(counts, np.int64)
        self.text = np.repeat(np.arange(len(counts)), self.counts)
        self.left = np.repeat(np.cumsum(self.counts), self.counts) - np.arange(len(sizes))  # words to the text's end
        self.size = np.array(sizes, np.int64)
        self.end = np.array(ends, np.uint32)
        before = np.zeros(len(sizes), np.uint32)
        if len(sizes):
            # The separator is one more byte: the CRC before it, moved over a byte, and its own.
            before[1:] = shifted(self.end[:-1], np.ones(len(sizes) - 1, np.int64)) ^ np.uint32(crc32(b" "))
            before[self.left == self.counts[self.text]] = 0
        self.start = before

    def grams(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By run length, the text of every run of words and its CRC."""
        for n in range(1, most + 1):
            first = np.flatnonzero(self.left >= n)
            span = sum((self.size[first + k] for k in range(n)), np.full(len(first), n - 1))
            yield self.text[first], self.end[first + n - 1] ^ shifted(self.start[first], span)


def _portions(texts: pd.Series) -> Iterator[list[str | None]]:
    """Texts in lists of about ``AT_ONCE`` words; a longer text is a list of its own."""
    held, size = [], 0
    for text in texts:
        text = text if isinstance(text, str) else None
        if held and size + len(text or "") > 6 * AT_ONCE:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield held


def bucket_counts(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all runs of 1 to ``grams`` words of all texts: at most one row a bucket."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _portions(batch["text"]):
                for _, crc in Scanned(texts).grams(grams):
                    total += np.bincount(crc % buckets, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen.astype(np.int32), "n": total[seen]})

    return docs.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))), in doubles.

    Without words on either side the counts are 0 and the formula holds. The driver holds a number per bucket.
    """
    def counted(texts: DataFrame) -> list[int]:
        found = dict(bucket_counts(texts, grams, buckets).collect())  # at most one row a bucket
        return [found.get(b, 0) for b in range(buckets)]

    s, t = counted(docs), counted(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t, strict=True)],
                    np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the sum of its features' gains; 0 without words."""
    def of(texts: pd.Series) -> pd.DataFrame:
        parts = []
        for held in _portions(texts):
            scanned = Scanned(held)
            features, weight = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
            for text, crc in scanned.grams(grams):
                features += np.bincount(text, minlength=len(held))
                # Sums of whole numbers below 2^53 are exact in doubles.
                weight += np.bincount(text, gain[crc % len(gain)], len(held)).astype(np.int64)
            parts.append(pd.DataFrame({"n_words": scanned.counts, "n_features": features, "weight": weight}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
            {c: np.zeros(0, np.int64) for c in ("n_words", "n_features", "weight")})

    return per_text(docs, of, "n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from a hash of the id; a null id hashes as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    unit = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(unit))).cast("long")


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the highest scores, null for rows that are not drawn.

    Of the N rows with ``least_words`` words or more floor(percent * N / 100) are drawn; ties go to the smaller doc_id
    (null last), equal rows in any order. Rows are laid out in ranges of the score, so that only the ranges' sizes are
    summed in one place.
    """
    order = [F.col("_low"), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie")]
    # Written before the ranges, whose bounds take a look at all rows first.
    scored = settle(scored, "weights")
    ranged = settle(
        scored.withColumn("_low", F.coalesce(F.col("n_words") < least_words, F.lit(True)))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()), "scored")
    part = F.shiftright("_row", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_low")).alias("_can"))
    everything = Window.partitionBy()
    # A row for each range.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias("_before"),
        F.floor(F.sum("_can").over(everything) * F.lit(percent) / F.lit(100)).alias("_drawn"))
    place = F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1) + 1
    placed = ranged.withColumn("_part", part).join(offsets, "_part")
    rank = F.when((place <= F.col("_drawn")) & ~F.col("_low"), place).cast("long")
    return placed.select(*[F.col(c) for c in scored.columns], rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score and rank (null if not drawn).

    Null, empty and wordless texts have no features and weight 0, and are never drawn. Repeated rows are rows of their own.
    An empty table gives an empty one. Other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    gain = gains(docs, target, grams, buckets)
    weighed = with_weights(docs, gain, grams).drop("text")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return drawn(scored, percent, least_words)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents drawn, whole, with their ``rank``; a column of that name is replaced. Rows that share a doc_id are
    drawn together if one of them is."""
    chosen = resample(docs, target, **options).filter("rank is not null").groupBy(
        F.col("doc_id").alias("_id")).agg(F.min("rank").alias("rank"))
    return docs.drop("rank").join(chosen, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
