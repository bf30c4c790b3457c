"""Benchmark decontamination: windows of benchmark words looked up in whole documents.

The hash set of all benchmark windows is broadcast, after a check of its size; every hit is verified
word by word. A benchmark beyond the bound is joined by window instead, with the same result.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ascii_lower, per_text, settle

# Words in UTF-8 after lower-casing A-Z: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Characters of benchmark text that may be collected and broadcast: at most a window for every second one, of about
#: 100 bytes each, so 400 MB in a task; 130 MB for words of five letters.
BROADCAST_CHARS = 8_000_000

RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "hit_spans array<struct<start: int, end: int>>")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def digest(ids) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


class Windows:
    """All windows of a benchmark: word numbers, and by window length the sorted window hashes, the windows, and
    whose they are (numbers of items, those of window i from firsts[i] up to firsts[i + 1])."""

    def __init__(self, items: list[tuple], window: int):
        self.vocabulary: dict[bytes, int] = {}
        numbers: dict = {}
        by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item_id, text in items:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if found:
                size = min(window, len(found))
                rows = np.lib.stride_tricks.sliding_window_view(np.array(found, np.uint64), size)
                number = numbers.setdefault(item_id, len(numbers))
                by_size.setdefault(size, []).append((rows, np.full(len(rows), number)))
        self.ids = list(numbers)
        self.by_length = []
        for size, parts in sorted(by_size.items()):
            rows, which = np.unique(np.concatenate([r for r, _ in parts]), axis=0, return_inverse=True)
            seed = 1
            while len(np.unique(keys := self._hash(rows, seed))) < len(rows):
                seed += 1
            order = np.argsort(keys)
            place = np.empty(len(rows), np.int64)
            place[order] = np.arange(len(rows))
            owned = np.unique(place[which.ravel()] * len(numbers) + np.concatenate([n for _, n in parts]))
            firsts = np.searchsorted(owned, np.arange(len(rows) + 1) * len(numbers))
            self.by_length.append(
                (size, seed, keys[order], rows[order], firsts, (owned % len(numbers)).astype(np.int32)))

    @staticmethod
    def _factors(size: int, seed: int) -> np.ndarray:
        return np.random.default_rng([seed, size]).integers(1, 2**63, size, np.uint64) | np.uint64(1)

    def _hash(self, rows: np.ndarray, seed: int) -> np.ndarray:
        return (rows * self._factors(rows.shape[1], seed)).sum(axis=1, dtype=np.uint64)

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in a benchmark window, and the items those windows come from."""
        hit = np.zeros(len(words) + 1, np.int64)
        items: set = set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for size, seed, keys, rows, firsts, owners in self.by_length:
            if len(ids) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            got = np.zeros(len(starts), np.uint64)
            for j, factor in enumerate(self._factors(size, seed)):
                got += ids[starts + j] * factor
            at = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
            same = keys[at] == got
            starts, at = starts[same], at[same]
            real = np.ones(len(starts), bool)
            for j in range(size):
                real &= ids[starts + j] == rows[at, j]
            starts, at = starts[real], at[real]
            np.add.at(hit, starts, 1)
            np.add.at(hit, starts + size, -1)
            for i in np.unique(at):
                items.update(self.ids[n] for n in owners[firsts[i]:firsts[i + 1]])
        return np.cumsum(hit[:-1]) > 0, items


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated and hit_spans (word numbers).

    Columns of these names in ``docs`` are replaced. A null or empty text has no words. Items of one
    id are one item; an item without words never matches; a null id counts as one item and leaves no
    name in the digest. An empty benchmark marks nothing.
    """
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"]
    if chars > broadcast_chars:
        return _mark_by_join(docs.drop(*added), items, window)
    grams = docs.sparkSession.sparkContext.broadcast(
        Windows([tuple(r) for r in items.collect()], window))

    def scan(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = words_of(text)
            hit, found = grams.value.find(words)
            out.append((len(words), int(hit.sum()), len(found),
                        digest(i for i in found if i is not None), bool(hit.any()), _spans(hit)))
        return pd.DataFrame(out, columns=added)

    return per_text(docs, scan, RESULT)


def _mark_by_join(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """The same by a join on windows, for benchmarks that are too large to broadcast."""
    parts = F.filter(F.split(ascii_lower(F.col("text")), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"),
                     lambda w: w != "")
    words = F.coalesce(parts, F.array().cast("array<string>"))

    def windows(df: DataFrame, size) -> DataFrame:
        starts = F.when(F.size("_words") >= size, F.sequence(F.lit(1), F.size("_words") - size + 1))
        return df.select("*", F.explode(starts).alias("_at")).withColumn(
            "_gram", F.concat_ws(" ", F.slice("_words", F.col("_at"), size)))

    own = items.withColumn("_words", words).filter(F.size("_words") > 0)
    own = own.withColumn("_size", F.least(F.size("_words"), F.lit(window)))
    grams = settle(windows(own, F.col("_size")).select("item_id", "_gram", "_size").distinct(), "grams")
    rows = settle(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
    texts = rows.select("_row", words.alias("_words"))
    sizes = [r[0] for r in grams.select("_size").distinct().collect()]  # at most `window` values
    hits = None
    for size in sizes:
        part = windows(texts, F.lit(size)).select("_row", "_at", "_gram").join(
            grams.filter(F.col("_size") == size).drop("_size"), "_gram").select(
            "_row", "_at", "item_id", F.lit(size).alias("_size"))
        hits = part if hits is None else hits.union(part)
    if hits is None:
        hits = rows.select("_row", F.lit(1).alias("_at"), F.lit(None).cast("long").alias("item_id"),
                           F.lit(0).alias("_size")).limit(0)
    hits = settle(hits, "hits")
    covered = (hits.select("_row", F.explode(F.sequence("_at", F.col("_at") + F.col("_size") - 1))
                           .alias("_p")).distinct()
               .groupBy("_row").agg(F.sort_array(F.collect_list("_p")).alias("_hit")))
    found = hits.select("_row", "item_id").distinct().groupBy("_row").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(F.col("item_id").cast("string")))), 256)
        .alias("items_sha256"))
    firsts = F.filter("_hit", lambda p, i: (i == 0) | (F.get("_hit", i - 1) != p - 1))
    lasts = F.filter("_hit", lambda p, i: (i == F.size("_hit") - 1) | (F.get("_hit", i + 1) != p + 1))
    spans = F.zip_with(firsts, lasts, lambda a, b: F.struct((a - 1).alias("start"), b.alias("end")))
    n_hit = F.coalesce(F.size("_hit"), F.lit(0))
    joined = rows.join(covered, "_row", "left").join(found, "_row", "left")
    return joined.select(
        *docs.columns, F.size(words).cast("long").alias("n_words"),
        F.when(F.col("_hit").isNull(), 0).otherwise(n_hit).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("_hit").isNotNull().alias("contaminated"),
        F.coalesce(spans, F.array().cast("array<struct<start: int, end: int>>")).alias("hit_spans"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with the columns of ``docs``."""
    packed = docs.select(F.struct("*").alias("_doc"), "text")
    return mark(packed, benchmark, window).filter(~F.col("contaminated")).select("_doc.*")
