"""Embedding near-duplicates by a pivot-permutation index.

Each vector is described by its nearest reference points in order. Inverted lists by sets of ``SHARED`` pivots
hold the vectors that have all of them in their prefix, so two vectors of a list share at least that
many; pairs are verified by their cosine in double precision. The index covers every row; only the reference points come
from a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import settle, split_hot
from clickloom.llm.components import components
from clickloom.llm.simhash import local_roots, whole_groups

THRESHOLD = 0.98
#: Reference points: the cube root of the number of different vectors times PER_VECTOR within these bounds, so that
#: lists stay as long on average when the table grows. They are picked from SAMPLE_PER_PIVOT times as many vectors.
LEAST_PIVOTS = 256
MOST_PIVOTS = 1024
PER_VECTOR = 30
SAMPLE_PER_PIVOT = 8
#: Pivots of a vector's prefix, and how many of them two vectors must share.
PREFIX = 5
SHARED = 3
#: Bits of a pivot's number in the name of a list.
PIVOT_BITS = 20
#: Vectors of one list compared in one group; longer lists are cut and each two parts meet.
LIST = 256
#: Groups of up to so many vectors write down their pairs; pairs looked at together.
SMALL = 48
AT_ONCE = 1 << 16
#: Vectors described together.
DESCRIBED = 1024


def usable(vector: Column) -> Column:
    """Whether the vector is neither null nor empty nor zero, and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def pivots_for(vectors: int) -> int:
    """Reference points for so many different vectors."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, round((PER_VECTOR * vectors) ** (1 / 3))))


def reference_points(vectors: DataFrame, many: int) -> dict[int, np.ndarray]:
    """At most ``many`` unit reference points by dimension, far apart from each other, from a bounded sample of ``vector``.

    A dimension with a smaller sample has fewer points, as neighbours among them would blur the order of the nearest.
    """
    order = F.xxhash64(F.lit(3), "vector")
    sample = vectors.select("vector").distinct().orderBy(order, "vector").limit(many * SAMPLE_PER_PIVOT).collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    points = {}
    for size, own in by_size.items():
        unit = _unit(np.array(own, np.float64))
        picked = [0]
        near = unit @ unit[0]
        while len(picked) < min(many, len(unit) // SAMPLE_PER_PIVOT) and near.min() < 1 - 1e-9:
            picked.append(int(near.argmin()))
            near = np.maximum(near, unit @ unit[picked[-1]])
        points[size] = unit[picked]
    return points


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _prefixes(unit: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The PREFIX nearest pivots of each vector, nearest first."""
    near = unit @ points.T
    picked = np.argpartition(-near, PREFIX - 1, axis=1)[:, :PREFIX]
    order = np.argsort(-np.take_along_axis(near, picked, axis=1), axis=1, kind="stable")
    return np.take_along_axis(picked, order, axis=1)


def _signatures(vectors: list, points: dict[int, np.ndarray]) -> list[tuple[list[int], list[int]]]:
    """Of each vector: its prefix, nearest pivot first, and its lists (sets of SHARED pivots, packed in order).

    A vector of a size without enough reference points goes to one list of its size, so nothing is missed.
    """
    out: list = [None] * len(vectors)
    sizes = np.array([len(v) for v in vectors])
    sets = np.array(list(combinations(range(PREFIX), SHARED)))
    for size in np.unique(sizes):
        every = np.flatnonzero(sizes == size)
        own = points.get(int(size))
        for first in range(0, len(every), DESCRIBED):
            at = every[first:first + DESCRIBED]
            if own is None or len(own) < PREFIX:
                for i in at:
                    out[i] = ([], [0])
                continue
            prefix = _prefixes(_unit(np.stack([np.asarray(vectors[i], np.float64) for i in at])), own)
            members = np.sort(prefix, axis=1)[:, sets]
            lists = (members << (PIVOT_BITS * np.arange(SHARED)[::-1])).sum(axis=2)
            for i, p, x in zip(at, prefix.tolist(), lists.tolist(), strict=True):
                out[i] = (p, x)
    return out


def _lowest_shared(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The list of the lowest SHARED pivots that stand in both of each two prefixes (in pivot order)."""
    both = (one[:, :, None] == other[:, None, :]).any(axis=2)
    place = np.cumsum(both, axis=1)
    shift = PIVOT_BITS * np.clip(SHARED - place, 0, SHARED)
    return (np.where(both & (place <= SHARED), one, 0) << shift).sum(axis=1)


def _sliced(test: Callable[[np.ndarray, np.ndarray], np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs pass the test, a slice at a time."""
    parts = [test(a[at:at + AT_ONCE], b[at:at + AT_ONCE]) for at in range(0, len(a), AT_ONCE)]
    return np.concatenate([np.zeros(0, bool), *parts])


def _verified(frame: pd.DataFrame, group: list[str], threshold: float) -> pd.DataFrame:
    """Of whole groups (label, size, list, two chunks): weight of direct links and the set's root, by vector.

    A pair meets in several lists; it counts in the one of its lowest shared pivots. Small groups write down their
    pairs, count the shared pivots and verify what is left; in large ones a product of matrices is quicker.
    """
    new = np.zeros(len(frame), bool)
    for name in group:
        own = frame[name].to_numpy()
        new[1:] |= own[1:] != own[:-1]
    starts = np.concatenate(([0], np.flatnonzero(new)))
    sizes = np.diff(np.append(starts, len(frame)))
    unit = _unit(np.stack(frame["vector"].to_numpy()).astype(np.float64))
    prefix = np.sort(np.array(frame["prefix"].tolist(), np.int64).reshape(len(frame), -1), axis=1)
    lists = frame["list"].to_numpy()
    chunk, low, high = (frame[c].to_numpy() for c in ("chunk", "low", "high"))

    def counted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # Where there are no pivots, the one list has the number 0, and so has the empty set.
        return _lowest_shared(prefix[a], prefix[b]) == lists[a]

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold

    small = np.repeat(sizes <= SMALL, sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(frame)) - 1  # later rows of the same group
    left[~small] = 0
    firsts, seconds = [], []
    work = np.cumsum(left) // AT_ONCE
    for turn in np.unique(work[left > 0]):
        rows = np.flatnonzero((work == turn) & (left > 0))
        many = left[rows]
        a = np.repeat(rows, many)
        b = a + 1 + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        meet = (low[a] == high[a]) | (chunk[a] != chunk[b])
        a, b = a[meet], b[meet]
        kept = _sliced(counted, a, b)
        a, b = a[kept], b[kept]
        kept = _sliced(close, a, b)
        firsts.append(a[kept])
        seconds.append(b[kept])
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        at = np.arange(start, start + size)
        one, other = at[chunk[at] == low[at]], at[chunk[at] == high[at]]
        a, b = np.nonzero(unit[one] @ unit[other].T >= threshold)
        a, b = one[a], other[b]
        meet = (low[start] != high[start]) | (a < b)
        a, b = a[meet], b[meet]
        kept = _sliced(counted, a, b)
        firsts.append(a[kept])
        seconds.append(b[kept])
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (firsts, seconds))
    copies = frame["copies"].to_numpy()
    weight = np.bincount(a, copies[b], len(frame)) + np.bincount(b, copies[a], len(frame))
    root = local_roots(len(frame), a, b)
    rep = frame["rep"].to_numpy()
    some = weight > 0
    return pd.DataFrame({"rep": rep[some], "links": weight[some].astype(np.int64), "root": rep[root[some]]})


def _by_size(frame: pd.DataFrame, group: list[str], threshold: float) -> Iterator[pd.DataFrame]:
    """Vectors of different sizes do not stand in one matrix."""
    for _, own in frame.groupby("size", sort=False):
        yield _verified(own.reset_index(drop=True), group, threshold)


def verified_links(reps: DataFrame, threshold: float) -> DataFrame:
    """``(rep, links, root)`` from ``reps(rep, label, vector, copies)``: partial counts of the links, and ties."""
    points = reps.sparkSession.sparkContext.broadcast(
        reference_points(reps, pivots_for(reps.count())))

    def describe(vectors: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_signatures(list(vectors), points.value), columns=["prefix", "lists"])

    made = F.pandas_udf(describe, "prefix array<int>, lists array<long>").asNondeterministic()
    index = settle(reps.withColumn("_s", made("vector")).select(
        "rep", "label", "vector", "copies", F.size("vector").alias("size"), "_s.prefix", "_s.lists"), "index")
    keys = ["label", "size", "list"]
    posted = index.select("rep", "label", "size", F.explode("lists").alias("list"))
    groups = split_hot(posted, keys, "rep", LIST).join(index.select("rep", "vector", "copies", "prefix"), "rep")
    group = [*keys, "low", "high"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, group, 1 << 12):
            yield from _by_size(frame, group, threshold)

    return groups.repartition(*group).sortWithinPartitions(*group).mapInPandas(
        verify, "rep long, links long, root long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings(vec_id, embedding, label)``.

    Only vectors of one non-null label and one size are compared; vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Equal vectors are one entry of the index with a number of copies, and count
    as links of each other. A null vec_id takes part and is passed over as the component's least id, unless all are
    null; kept is false for it.
    """
    rows = embeddings.select("vec_id", "label", F.col("embedding").alias("vector"),
                             (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("ok"))
    reps = settle(rows.filter("ok").groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("rep", F.monotonically_increasing_id()), "vectors")
    found = settle(verified_links(reps, threshold), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    member = settle(reps.join(counts, "rep", "left")
                    .join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "vector", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("root")), "members")
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    known = settle(member.join(least, "root").select("label", "vector", "n_links", "least"), "classes")
    inside = rows.filter("ok").join(known, ["label", "vector"]).select("vec_id", "n_links", "least")
    outside = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("least"))
    return inside.union(outside).select(
        "vec_id", "n_links", F.col("least").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("least"), F.lit(False)).alias("kept"))
