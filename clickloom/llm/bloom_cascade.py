"""Exact membership by a cascade of Bloom filters.

Level 1 holds the listed keys. Level 2 holds those keys of the universe that level 1 takes for listed though they
are not, level 3 the listed keys that level 2 takes for those, and so on until no key is mistaken. For each key of the
universe the first level that misses it then tells for certain whether it is listed: missed by an odd level, it is not.

A level has so many bits that about as few keys of the other side are mistaken as it holds itself, so levels follow the
list and not the universe. Levels of up to ``PART_KEYS`` keys are bit arrays in the query itself, so asking them takes
neither a join nor a shuffle. A larger level is cut into parts by a hash of the key, a bit array each, and keys are brought to
their part: no list is too long.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import host_of, path_of, settle

#: Keys of a part of a level: some 5 to 10 MB of bits.
PART_KEYS = 4_000_000
BITS_PER_KEY = 10
MOST_HASHES = 32


@dataclass(frozen=True)
class Level:
    turn: int
    parts: int
    bits: int  # of a part
    hashes: int
    words: DataFrame | None = None  # part, words: a row for each part

    def part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.turn), F.lit(-1), key), F.lit(self.parts)).cast("int")

    def places(self, key: Column) -> list[Column]:
        """The key's bits: one hash, and steps of another."""
        start, step = (F.pmod(F.xxhash64(F.lit(self.turn), F.lit(i), key), F.lit(self.bits)) for i in range(2))
        return [F.pmod(start + step * i, F.lit(self.bits)) for i in range(self.hashes)]

    def _held(self, words: Column, key: Column) -> Column:
        found = F.lit(True)
        for bit in self.places(key):
            found = found & (F.getbit(F.get(words, F.floor(bit / 64).cast("int")), F.pmod(bit, F.lit(64))) == 1)
        return found

    def ask(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the boolean ``name``: whether the level may hold the key."""
        if self.parts == 1:
            return rows.withColumn(name, self._held(self.words.select("words").scalar(), F.col(key)))
        parts = self.words.select(F.col("part").alias("_part"), "words")
        asked = rows.withColumn("_part", self.part(F.coalesce(key, F.lit("")))).join(parts.hint("merge"), "_part", "left")
        return asked.withColumn(name, self._held(F.col("words"), F.col(key))).drop("_part", "words")


def _level(keys: DataFrame, turn: int, n: int, others: int, part_keys: int) -> Level:
    """A level of ``n`` keys that mistakes about ``n`` of ``others``."""
    wanted = max(1.0, others / n)
    per_key = max(BITS_PER_KEY, math.ceil(math.log(wanted) / math.log(2) ** 2))
    parts = -(-n // part_keys)
    size = -(-max(64, -(-n // parts) * per_key) // 64)
    level = Level(turn, parts, size * 64, min(MOST_HASHES, max(5, round(per_key * math.log(2)))))
    bits = F.explode(F.array(*level.places(F.col("key"))))
    ored = keys.select(level.part(F.col("key")).alias("part"), bits.alias("bit")).groupBy(
        "part", F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) as int))")).alias("word"))
    # Words without a bit are filled in between those that have one, which are as many as the part's size allows.
    gap = F.expr("""flatten(transform(w, (x, i) -> concat(
        array_repeat(0L, x.at - coalesce(get(w, i - 1).at, -1) - 1), array(x.word))))""")
    words = ored.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")).select(
        "part", gap.alias("words"))
    return Level(turn, parts, size * 64, level.hashes, settle(words, "bloom"))


class Cascade:
    """The levels for ``listed`` keys, exact on every key of ``universe`` (columns ``key``, repeats allowed).

    Null keys are not listed. An empty list answers false for every key.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, part_keys: int = PART_KEYS):
        keys = settle(
            listed.select("key", F.lit(True).alias("listed"))
            .union(universe.select("key", F.lit(False))).filter("key is not null")
            .groupBy("key").agg(F.max("listed").alias("listed")), "keys")
        mine, others = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
        n, against = mine.count(), others.count()
        self.levels: list[Level] = []
        while n:
            level = _level(mine, len(self.levels) + 1, n, against, part_keys)
            self.levels.append(level)
            mistaken = settle(level.ask(others, "key", "_held").filter("_held").select("key"), "mistaken")
            mine, others, n, against = mistaken, mine, mistaken.count(), n

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the boolean ``name``: whether the key is listed. Exact for keys of the universe; null gives false."""
        answer = F.lit(len(self.levels) % 2 == 1)
        asked = [f"_level{level.turn}" for level in self.levels]
        for level, column in zip(self.levels, asked, strict=True):
            rows = level.ask(rows, key, column)
        for at in range(len(asked), 0, -1):
            answer = F.when(F.col(asked[at - 1]), answer).otherwise(F.lit(at % 2 == 0))
        return rows.withColumn(name, F.col(key).isNotNull() & F.coalesce(answer, F.lit(False))).drop(*asked)


class UrlRules:
    """Block and allow rules by host, or host and start of the path, decided by cascades.

    ``rules`` has ``key`` (``net/es/``, or a bare host) and ``verdict`` (allow or block; a key listed as both is
    blocked). A rule fits its host and all subdomains if the url's path starts with the rule's; the longest
    fitting rule wins, of equally long ones that with the longer host. Rows without a key are left out; no rules give
    null verdicts. One cascade finds the domains of a url that rules are about, others the rules themselves.
    """

    def __init__(self, rules: DataFrame, urls: DataFrame, part_keys: int = PART_KEYS):
        """``urls`` has ``host`` and ``path``: every url that will be asked about."""
        rules = rules.filter("key is not null and key != ''")
        host = F.substring_index("key", "/", 1)
        # A row for each length of a rule's host, with the lengths of the paths that follow such hosts.
        lengths = rules.select(F.length(host).alias("h"), (F.length("key") - F.length(host)).alias("p")).groupBy("h").agg(
            F.sort_array(F.collect_set("p")).alias("p")).collect()
        self.paths = {r["h"]: r["p"] for r in lengths}
        asked = urls.select("host", "path").distinct()
        domains = settle(self._domains(asked), "domains")
        self.hosts = Cascade(rules.select(host.alias("key")), domains.select(F.col("_domain").alias("key")).distinct(), part_keys)
        universe = settle(self._keys(self.hosts.mark(domains, "_domain", "_known").filter("_known")).select(
            F.col("_key").alias("key")).distinct(), "universe")
        self.block = Cascade(rules.filter("verdict = 'block'").select("key"), universe, part_keys)
        self.allow = Cascade(rules.filter("verdict = 'allow'").select("key"), universe, part_keys)

    def _domains(self, urls: DataFrame) -> DataFrame:
        """``urls`` once for each end of the host, cut at a label, that is as long as some rule's host."""
        lengths = F.array(*[F.lit(h) for h in sorted(self.paths)]).cast("array<int>")
        size = F.length("host")
        fitting = F.filter(lengths, lambda h: (h == size) | (
            (h < size) & (F.substring(F.col("host"), size - h, F.lit(1)) == ".")))
        return urls.withColumn("_h", F.explode(fitting)).withColumn("_domain", F.right("host", F.col("_h")))

    def _keys(self, domains: DataFrame) -> DataFrame:
        """``domains`` once for each key, domain and start of the path, as long as some rule on a host of this length."""
        pairs = [x for h, ps in sorted(self.paths.items()) for x in (F.lit(h), F.array(*[F.lit(p) for p in ps]))]
        lengths = F.element_at(F.create_map(*pairs), F.col("_h")) if pairs else F.array().cast("array<int>")
        fitting = F.filter(lengths, lambda p: p <= F.length("path"))
        return domains.withColumn("_p", F.explode(fitting)).withColumn(
            "_key", F.concat("_domain", F.left("path", F.col("_p"))))

    def decided(self, urls: DataFrame) -> DataFrame:
        """``_row, _rule``: for urls with a fitting rule the struct of its lengths, key and verdict.

        A url's keys are rows of their own in one task, so a partial aggregation leaves one row per url to shuffle.
        """
        known = self.hosts.mark(self._domains(urls.select("_row", "host", "path")), "_domain", "_known").filter("_known")
        asked = self.allow.mark(self.block.mark(self._keys(known), "_key", "_block"), "_key", "_allow").filter("_block or _allow")
        rule = F.struct((F.col("_h") + F.col("_p")).alias("size"), F.col("_h").alias("host"), F.col("_key").alias("key"),
                        F.when(F.col("_block"), "block").otherwise("allow").alias("verdict"))
        return asked.groupBy("_row").agg(F.max(rule).alias("_rule"))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, part_keys: int = PART_KEYS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    The rules decide first; a url without a rule is blocked if its host, or a domain above it, is in
    ``listed(key)``, else allowed. A null url or one without ``://`` has an empty host and path and is allowed.
    """
    urls = settle(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
                  .withColumn("_row", F.monotonically_increasing_id()), "urls")
    by_rule = UrlRules(rules, urls, part_keys)
    by_list = UrlRules(listed.select("key", F.lit("block").alias("verdict")), urls, part_keys)
    listed_rows = by_list.decided(urls).withColumnRenamed("_rule", "_listed")
    return urls.join(by_rule.decided(urls), "_row", "left").join(listed_rows, "_row", "left").select(
        "page_id", "host", "path", F.col("_rule.key").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.col("_listed.verdict"), F.lit("allow")).alias("verdict"))
