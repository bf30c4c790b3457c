"""SimHash near-duplicates, found by Burkhard-Keller trees.

Two fingerprints within ``RADIUS`` = 4 bits agree on at least two of six blocks of bits, on three of seven and so on, so
each choice of that many blocks and their values names a shard in which close fingerprints meet. The more fingerprints
there are, the more blocks name a shard. Every shard gets a BK-tree: children are
keyed by their integer Hamming distance to the parent, and a search follows only edges within the radius.
Trees travel with the shard's fingerprints; there is one row per different fingerprint, however many copies it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import KEY, different_rows, per_text, row_key, settle, split_hot
from clickloom.llm.components import components

WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a shard that are put into one tree; larger shards are cut and each two parts meet.
TREE = 1024
#: Unrelated fingerprints of one shard on average, at most.
MEET = 16
#: The same for items with sketches, some 2 MB; in groups of CROWD items and more, PIVOTS items are compared with all first.
ITEMS = 1 << 15
CROWD = 64
PIVOTS = 8
#: Comparisons made at once in a search.
AT_ONCE = 1 << 21

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """Bit i is set if it is in over half of the hashes of the 4-word shingles, repeats included.

    Words are split at blanks, tabs and line ends after lower-casing A-Z; fewer words are one shingle, none give 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    width = min(WORDS, len(words))
    ends = (starts + sizes)[width - 1:].tolist()
    digests = [xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)]
    bytes_ = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)[:, ::-1]
    counts = np.concatenate([np.bincount(bytes_[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(((counts * 2 > len(digests)).astype(np.uint64) << _PLACES).sum(dtype=np.uint64))


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``bits``, the fingerprint as a signed long."""
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"bits": np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)})

    return per_text(docs, of, "bits long")


def agreeing(items: int, values: float = 64) -> int:
    """How many blocks a shard's fingerprints agree in, so that there are ``values`` times as many values as items."""
    wanted = 2
    while wanted < 8 and 64 * wanted // (RADIUS + wanted) < int(values * max(items, 1)).bit_length():
        wanted += 1
    return wanted


def _wide_keys(bits: Column, wanted: int) -> Column:
    """A hash for each choice of ``wanted`` blocks out of RADIUS more and of what these hold: two fingerprints within
    the radius share at least one, whatever ``wanted`` is."""
    count = RADIUS + wanted
    edges = [64 * i // count for i in range(count + 1)]
    parts = [F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.xxhash64(F.lit(n), *[parts[i] for i in chosen])
                     for n, chosen in enumerate(combinations(range(count), wanted))])


def local_roots(size: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Roots of ``size`` items after linking a with b: equal for linked items, the least item of each set."""
    root = np.arange(size) if root is None else root
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(root, before):
            return root


class Forest:
    """BK-trees of many groups, built and searched level by level. Members of a group differ from each other."""

    def __init__(self, group: np.ndarray, bits: np.ndarray):
        self.bits = bits
        count = int(group.max()) + 1 if len(group) else 0
        self.roots = np.full(count, -1)
        parents, edges, children = [], [], []
        pending = np.arange(len(bits))
        slot = group.astype(np.int64)  # the subtree an item belongs to
        first_level = True
        while len(pending):
            order = np.argsort(slot, kind="stable")
            pending, slot = pending[order], slot[order]
            new, start, own = np.unique(slot, return_index=True, return_inverse=True)
            node = pending[start]
            if first_level:
                self.roots[new] = node
                first_level = False
            else:
                parents.append(new // 65)
                edges.append(new % 65)
                children.append(node)
            rest = np.ones(len(pending), bool)
            rest[start] = False
            parent = node[own][rest]
            pending = pending[rest]
            slot = parent * 65 + np.bitwise_count(bits[pending] ^ bits[parent]).astype(np.int64)
        key = (np.concatenate(parents) * 65 + np.concatenate(edges)) if parents else np.zeros(0, np.int64)
        child = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.keys, self.children = key[order], child[order]

    def search(self, group: np.ndarray, bits: np.ndarray, equal: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, member) within the radius, equal ones left out unless asked for."""
        query = np.flatnonzero(self.roots[group] >= 0)
        node = self.roots[group[query]]
        found_q, found_m = [], []
        while len(query):
            distance = np.bitwise_count(bits[query] ^ self.bits[node]).astype(np.int64)
            near = (distance <= RADIUS) & (equal | (distance > 0))
            found_q.append(query[near])
            found_m.append(node[near])
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - RADIUS, 0))
            many = np.searchsorted(self.keys, node * 65 + np.minimum(distance + RADIUS, 64), "right") - low
            at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            query, node = np.repeat(query, many), self.children[at]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_m)


def _near(a: np.ndarray, b: np.ndarray, sketches: list[np.ndarray]) -> np.ndarray:
    """Which of the pairs have sketches that are close."""
    return sum(np.bitwise_count(s[a] ^ s[b]).astype(np.int64) for s in sketches) <= FAR


def _around_pivots(group: np.ndarray, bits: np.ndarray, sketches: list[np.ndarray],
                   root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of large groups to a few of their items, and the items that need not be searched for.

    In a group of copies of one text nearly all items are close to any of them. Those that end up in the group's largest set
    are linked already; every other item still looks through the whole group, so no link between sets is lost.
    """
    settled = np.zeros(len(bits), bool)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(starts, append=len(group))
    linked_a, linked_b = [], []
    for start, size in zip(starts[sizes >= CROWD].tolist(), sizes[sizes >= CROWD].tolist(), strict=True):
        own = np.arange(start, start + size)
        free = np.ones(size, bool)
        for _ in range(PIVOTS):
            left = np.flatnonzero(free)
            if not len(left):
                break
            pivot = np.full(size, own[left[len(left) // 2]])
            close = (np.bitwise_count(bits[own] ^ bits[pivot]) <= RADIUS) & _near(own, pivot, sketches)
            free &= ~close
            linked_a.append(own[close])
            linked_b.append(pivot[close])
    if linked_a:
        root = local_roots(len(bits), np.concatenate(linked_a), np.concatenate(linked_b), root)
        for start, size in zip(starts[sizes >= CROWD].tolist(), sizes[sizes >= CROWD].tolist(), strict=True):
            sets, many = np.unique(root[start:start + size], return_counts=True)
            settled[start:start + size] = root[start:start + size] == sets[many.argmax()]
    return root, settled


def _links(groups: pd.DataFrame, item: str = "bits", verified: bool = False) -> pd.DataFrame:
    """Links of whole groups (key, low, high): each linked item with the least of its set in the group.

    ``verified`` links only items whose sketches are close as well; their fingerprints may be equal.
    """
    starts = (groups[["key", "low", "high"]].diff() != 0).any(axis=1).to_numpy()
    group = np.cumsum(starts) - 1
    bits = groups["bits"].to_numpy().view(np.uint64)
    sketches = [groups[s].to_numpy().view(np.uint64) for s in SKETCH] if verified else []
    chunk, low, high = (groups[c].to_numpy() for c in ("chunk", "low", "high"))
    members, queries = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    root = np.arange(len(bits))
    if verified:
        # Items of both chunks look through both, as settled ones do not ask.
        root, settled = _around_pivots(group, bits, sketches, root)
        members, queries = np.arange(len(bits)), np.flatnonzero(~settled)
    forest = Forest(group[members], bits[members])
    sizes = np.bincount(group[members], minlength=group[-1] + 1)
    if len(forest.roots) < len(sizes):
        forest.roots = np.concatenate([forest.roots, np.full(len(sizes) - len(forest.roots), -1)])
    work = np.cumsum(sizes[group[queries]]) // AT_ONCE
    for turn in np.unique(work):
        asked = queries[work == turn]
        q, m = forest.search(group[asked], bits[asked], verified)
        a, b = asked[q], members[m]
        if verified:
            close = _near(a, b, sketches)
            a, b = a[close], b[close]
        root = local_roots(len(bits), a, b, root)
    linked = np.flatnonzero(root != np.arange(len(bits)))
    items = groups[item].to_numpy()
    return pd.DataFrame({"a": items[linked], "b": items[root[linked]]})


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Sorted batches regrouped so that each frame holds whole groups and about ``rows`` rows or more."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        if not last.all():
            yield frame[~last].reset_index(drop=True)
            frame = frame[last]
        held = [frame]
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def links(bits: DataFrame, tree: int = TREE, wanted: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the different fingerprints ``bits`` within the radius of each other.

    Unrelated fingerprints of a shard are ``MEET`` on average at most, up to 8 agreeing blocks of twelve (42 bits).
    Not every close pair is a row: in a shard each linked fingerprint is tied to the least one it reaches there.
    """
    wanted = wanted or agreeing(bits.count(), 1 / MEET)
    keyed = bits.select("bits", F.explode(_wide_keys(F.col("bits"), wanted)).alias("key"))
    groups = split_hot(keyed, ["key"], "bits", tree)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["key", "low", "high"], 1 << 16):
            yield _links(frame)

    return (groups.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInPandas(search, "a long, b long"))


def classes(bits: DataFrame) -> DataFrame:
    """``(bits, root)`` for every fingerprint that is linked with another one."""
    return components(links(bits.select("bits").distinct())).select(F.col("node").alias("bits"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    component_id is the least doc_id that links reach, the row's own included; nulls are passed over, and it is null
    only if all the group's ids are. Texts without words have fingerprint 0, linked like any other. An empty table
    gives an empty one.
    """
    prints = settle(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "bits"), "fingerprints")
    own = settle(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "different")
    member = settle(own.join(classes(own), "bits", "left")
                    .select("bits", "first", F.coalesce("root", "bits").alias("root")), "members")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    found = settle(member.join(least, "root").select("bits", "component_id"), "classes")
    return prints.join(found, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


# Whole texts: candidates by several fingerprints, verified by five-word shingles

#: Fingerprints of a text's different words, each with hashes of its own. Two texts are compared if any is within RADIUS.
FINGERPRINTS = 3
SHINGLE = 5
SKETCH = ["s0", "s1"]
#: Bits of two sketches that may differ: 1 - 2 * 19 / 128 = 0.7, two standard errors below a similarity of 0.8.
FAR = 19

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Hashes as if by another function."""
    with np.errstate(over="ignore"):
        x = (hashes ^ np.uint64(turn)) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _majority(hashes: np.ndarray) -> np.uint64:
    """A bit is set if it is set in over half of the hashes."""
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]


def profile(text: str | None) -> list[int]:
    """The text's item (a 64-bit hash of its words), its fingerprints and its sketch.

    A sketch has a bit of the least hash of the five-word shingles under each of 128 orders (fewer words are one shingle);
    two of them agree in a bit with probability (1 + s) / 2 at similarity s. Words are those of ``fingerprint``; texts
    without words are one item with zeros.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return [0] * (1 + FINGERPRINTS + len(SKETCH))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[min(SHINGLE, len(words)) - 1:].tolist()
    shingles = np.fromiter({xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)}, np.uint64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            least = np.minimum(least, (shingles[at:at + 4096, None] * _FACTORS).min(axis=0))
    sketch = np.packbits((_mixed(least, 0) >> np.uint64(63)).astype(np.uint8)).view(np.uint64)
    different = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in set(words)), np.uint64)
    return [xxhash.xxh64_intdigest(joined, SEED), *[int(_majority(_mixed(different, n))) for n in range(FINGERPRINTS)], *sketch.tolist()]


def with_profiles(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``profile``: item, p0 and so on, s0, s1."""
    names = ["item", *[f"p{n}" for n in range(FINGERPRINTS)], *SKETCH]

    def of(texts: pd.Series) -> pd.DataFrame:
        made = np.array([profile(t) for t in texts], np.uint64).reshape(len(texts), len(names))
        return pd.DataFrame(made.view(np.int64), columns=names)

    return per_text(docs, of, ", ".join(f"{n} long" for n in names))


def verified_links(items: DataFrame, tree: int = ITEMS, wanted: int | None = None) -> DataFrame:
    """Links ``(a, b)`` between items of which a fingerprint is within RADIUS and whose sketches say 0.7 or more.

    Shards are as narrow as the number of items asks for (``agreeing``), so that unrelated items seldom meet in one at any
    size. Candidates come out of trees as in ``links`` and are verified there; in a shard each linked item is tied to the least
    one it reaches.
    """
    wanted = wanted or agreeing(items.count())
    prints = F.array(*[F.struct(F.lit(n).alias("turn"), F.col(f"p{n}").alias("bits")) for n in range(FINGERPRINTS)])
    turns = items.select("item", *SKETCH, F.inline(prints))
    keyed = turns.select("item", "bits", *SKETCH, F.explode(_wide_keys(F.col("bits"), wanted)).alias("_key"), "turn").withColumn(
        "key", F.xxhash64("turn", "_key")).drop("_key", "turn")
    groups = split_hot(keyed, ["key"], "item", tree)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["key", "low", "high"], 1 << 16):
            yield _links(frame, "item", True)

    return (groups.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInPandas(search, "a long, b long"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least doc_id (null last), whole.

    Texts with the same words are one group; other texts belong together if links of ``verified_links`` connect them:
    five-word shingles alike in 0.8 or more, as far as 128 bits tell. Texts without words are one group.
    """
    keyed = docs.select("doc_id", "text", *row_key(docs))
    prints = settle(with_profiles(keyed).drop("text"), "profiles")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY)
    own = settle(prints.groupBy("item").agg(
        F.min(order).alias("first"), *[F.min(c).alias(c) for c in prints.columns if c not in ("item", "doc_id", *KEY)]), "items")
    roots = components(verified_links(own)).withColumnRenamed("node", "item")
    best = own.select("item", "first").join(roots, "item", "left").groupBy(F.coalesce("root", "item").alias("root")).agg(
        F.min("first").alias("first")).select(*[F.col(f"first.{k}") for k in KEY])
    return different_rows(docs).join(best, KEY, "left_semi").select("_doc.*")
