"""Main text by template deduction from equivalence classes.

Every page is cut into blocks of text below a path of block tags. Over the different pages of a host, tokens (a path, or
a text at a path) whose occurrence vectors are equal form a class. Vectors are compared by the number of pages and
occurrences and an exclusive-or of hashes of (page, occurrences), which Spark aggregates before it shuffles; no task
sees all pages of a host. A path that stands once on each of its pages and holds most of their text is a valid slot, as is
a path of articles, however many a page has; an article or main tag, then depth, decides between valid slots. Where equal
elements stand side by side, in the same number on each page, their places tell them apart, so that one of them can be the slot.
Texts in the class of a node above them belong to the template, inside articles too; so do classes of texts that turn up
on a good part of a host's pages and that no other host repeats. What remains in the page's slot is the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import host_of, per_text, settle

#: Share of a host's pages that a node or text of a layout stands on, and of these pages' text that a slot holds, at least.
COMMON = 0.02
MOST_TEXT = 0.6
#: Different pages that show a text to be the template's, at least.
SUPPORT = 4
#: A class that holds more of its pages' text are near copies, not a template.
COPIES = 0.9
#: Share of a host's different pages that texts outside the classes of nodes turn up on, and of a page's text that they hold, at most;
#: words of such a class, at least.
TURNS = 0.25
MOST_TURNS = 0.5
CLASS_WORDS = 3
#: Different pages on which a place among equal elements is the same, at least.
PLACES = 3

# Tags of HTML.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "select", "object", "canvas")
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp
small span strike strong sub sup time tt u var wbr br img""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that the start of another one ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Tags and words of class, id or role that mark what is not the article.
OUTSIDE_TAGS = frozenset("nav footer aside form button dialog menu head".split())
OUTSIDE_WORDS = frozenset("""ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation
menu breadcrumb breadcrumbs sidebar complementary footer contentinfo cookie cookies consent notice notices gdpr popup
modal newsletter subscribe signup login search comment comments reply replies discussion disqus share sharing social
related recommended widget widgets masthead toolbar pagination pager form alert""".split())
HEAD_WORDS = frozenset(("header", "masthead"))
MAIN_TAGS = frozenset(("article", "main"))
#: Tags of one text, which are no slot.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption".split())
#: Equal elements of these tags stand in lists and tables, or are slots together; their places say nothing.
UNPLACED = TEXT_TAGS | MAIN_TAGS | {"tr", "td", "th"}
#: Tags that hold a whole page, so that words such as has-sidebar say nothing about their text.
WHOLE_TAGS = frozenset(("html", "body", "main"))

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*+(?:>|\Z)|</?[a-z][^<>]*+\Z", re.I | re.S)
NAMED = re.compile(r"(?<![\w:-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

BLOCK = "struct<path: string, role: string, text: string, outside: boolean, named: boolean, main: boolean, times: long>"
PARSED = f"blocks array<{BLOCK}>, paths array<struct<path: string, times: long, chars: long, places: long>>, total long"


class Node:
    """An element: where it stands, what its tag and names say, and the text below it that no tag puts outside."""

    __slots__ = ("tag", "path", "role", "places", "up", "hard", "inside", "named", "outside", "main", "chars")

    def __init__(self, tag: str, path: str, words: set[str], up: Node | None):
        self.tag, self.path, self.up, self.chars = tag, path, up, 0
        self.role, self.places = "", 0
        inside = up is not None and up.inside
        self.named = tag not in WHOLE_TAGS and bool(words & OUTSIDE_WORDS or not inside and words & HEAD_WORDS)
        if tag in WHOLE_TAGS:
            self.hard = any(above.tag in OUTSIDE_TAGS for above in self.above())
        else:
            self.hard = up is not None and up.hard or tag in OUTSIDE_TAGS or not inside and tag == "header"
        self.inside = inside or tag in MAIN_TAGS and not self.hard
        self.outside = self.main = False

    def above(self) -> Iterator[Node]:
        node = self.up
        while node is not None:
            yield node
            node = node.up

    def clean(self) -> bool:
        """Whether no name on it or above it, up to a tag that holds a whole page, is one of what is outside."""
        for node in (self, *self.above()):
            if node.tag in WHOLE_TAGS:
                return True
            if node.named:
                return False
        return True


class Page:
    """One pass over the markup: blocks in page order, and how often each path is opened.

    Names alone do not put a node outside that holds over half of the page's text, in an article or on a page without one
    free of such names; nor, on such a page, one that holds a single article.
    """

    def __init__(self, source: str):
        self.blocks: list[dict] = []
        # The page itself is the path ''.
        self.nodes = [Node("", "", set(), None)]
        self.open = [self.nodes[0]]
        self.parts: list[str] = []
        self.times: dict[str, int] = {"": 1}
        self.chars: dict[str, int] = {}
        self.places: dict[str, int] = {}
        at = 0
        for m in MARKUP.finditer(source):
            self.parts.append(source[at:m.start()])
            at = m.end()
            if m["tag"]:
                self._tag(m["tag"].lower(), bool(m["close"]), m["rest"])
        self.parts.append(source[at:])
        self._end_block()
        self._decide()
        self._place()
        own = Counter((b["path"], b["text"]) for b in self.blocks)
        for b in self.blocks:
            node = b.pop("node")
            b.update(outside=node.outside, named=node.outside and not node.hard, main=node.main,
                     role=node.role if node.places else "", times=own[b["path"], b["text"]])
            if not node.outside:
                for own_or_above in (node, *node.above()):
                    for path in {own_or_above.path, own_or_above.role}:
                        self.chars[path] = self.chars.get(path, 0) + len(b["text"])
        self.total = self.chars.get("", 0)

    def _end_block(self) -> None:
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(self.parts)).split())
        self.parts = []
        if not text:
            return
        node = self.open[-1]
        self.blocks.append({"path": node.path, "text": text, "node": node})
        if not node.hard:
            for own in self.open:
                own.chars += len(text)

    def _tag(self, tag: str, close: bool, rest: str) -> None:
        if tag in INLINE:
            if tag in ("br", "img"):
                self.parts.append(" ")
            return
        self._end_block()
        if close:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    del self.open[i:]
                    break
            return
        if tag in VOID:
            return
        if self.open[-1].tag == "p" or self.open[-1].tag in ENDS.get(tag, ()):
            self.open.pop()
        names = " ".join(a or b or c for a, b, c in NAMED.findall(rest)).lower() if rest else ""
        words = set(re.split(r"[^a-z]+", names)) - {""}
        path = f"{self.open[-1].path}/{tag}" + (f".{'.'.join(sorted(words))}" if words else "")
        node = Node(tag, path, words, self.open[-1])
        self.nodes.append(node)
        if not rest.endswith("/"):
            self.open.append(node)
        self.times[path] = self.times.get(path, 0) + 1

    def _place(self) -> None:
        """Roles: paths in which each of several equal elements side by side has its place. ``places`` of a node follows from
        how many there are at each step down to it, and is 0 where there is one at every step."""
        equal = Counter((id(n.up), n.path) for n in self.nodes[1:] if n.tag not in UNPLACED)
        seen: Counter = Counter()
        for n in self.nodes[1:]:
            n.role, n.places = n.up.role + n.path[len(n.up.path):], n.up.places
            at = id(n.up), n.path
            if equal[at] > 1:
                seen[at] += 1
                n.role += f"~{seen[at]}"
                n.places = (n.places * 1_000_003 + len(n.path) * 8191 + equal[at]) % (1 << 61)
            if n.places and n.tag not in UNPLACED:
                self.times[n.role] = self.times.get(n.role, 0) + 1
                self.places[n.role] = n.places

    def _decide(self) -> None:
        named = [n for n in self.nodes if n.named and not n.hard]
        spared: set[int] = set()
        if named:
            outer = [n for n in self.nodes if n.tag in MAIN_TAGS and n.chars and not n.hard
                     and not n.up.inside]
            free = any(n.clean() for n in outer)
            held = Counter(id(a) for n in outer for a in n.above())
            single = {id(a) for n in outer if not n.named for a in n.above() if held[id(a)] == 1}
            if not free:
                spared = {id(n) for n in named if id(n) in single}
            for n in named:
                if 2 * n.chars > self.nodes[0].chars and (n.up.inside or not free and not spared - {id(n)}):
                    spared.add(id(n))
        for n in self.nodes[1:]:
            if n.tag in WHOLE_TAGS:
                n.outside = n.hard
            else:
                n.outside = n.hard or n.up.outside or n.named and id(n) not in spared
            n.main = n.up.main or n.tag in MAIN_TAGS and not n.outside


def parse(sources: pd.Series) -> pd.DataFrame:
    rows = []
    for source in sources:
        page = Page(source or "")
        rows.append((page.blocks, [{"path": p, "times": n, "chars": page.chars.get(p, 0), "places": page.places.get(p, 0)}
                                   for p, n in page.times.items()], page.total))
    return pd.DataFrame(rows, columns=["blocks", "paths", "total"])


def _vector() -> list[Column]:
    return [F.count(F.lit(1)).alias("pages"), F.sum("times").alias("times"),
            F.bit_xor(F.xxhash64("_page", "times")).alias("vector")]


def templates(parsed: DataFrame) -> DataFrame:
    """``(host, slots, texts, turning)``: each host's valid slots, best first, the template's texts as hashes with their path,
    and those of classes on some of the pages only.

    Pages of equal content count once. All lists are bounded: a node or text stands on ``COMMON`` of the host's pages.
    """
    hosts = parsed.select("host", "_page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    nodes = settle(
        parsed.select("host", "_page", "total", F.inline("paths")).distinct().groupBy("host", "path").agg(
            *_vector(), F.sum("chars").alias("chars"), F.sum("total").alias("all_chars"),
            F.min("places").alias("places"), F.max("places").alias("other_places"))
        .join(hosts, "host").filter(F.col("pages") >= F.greatest(
            F.col("all_pages") * F.lit(COMMON), F.least(F.lit(SUPPORT), F.col("all_pages") * 0.5))), "nodes")
    tag = F.element_at(F.split(F.element_at(F.split("path", "/"), -1), "[.~]"), 1)
    rank = F.struct(tag.isin(*MAIN_TAGS).alias("article"), F.size(F.split("path", "/")).alias("depth"), F.col("path"))
    slots = (nodes.filter("path <> '' and chars > 0").filter(~tag.isin(*TEXT_TAGS))
             .filter(tag.isin(*MAIN_TAGS) | (F.col("pages") == F.col("times")))
             .filter(F.col("chars") >= F.col("all_chars") * F.lit(MOST_TEXT))
             .filter((F.col("other_places") == 0)
                     | (F.col("places") == F.col("other_places")) & (F.col("pages") >= F.lit(PLACES)))
             .groupBy("host").agg(F.sort_array(F.collect_list(rank), asc=False)["path"].alias("slots")))
    # Texts in the class of a node above them, inside articles too.
    blanks = F.length("text") - F.length(F.translate("text", " ", ""))
    repeated = settle(
        parsed.select("host", "_page", F.inline("blocks")).filter("not outside")
        .select("host", "_page", "path", "times", F.xxhash64("path", "text").alias("text"),
                F.length("text").cast("long").alias("size"), (blanks + 1).alias("words")).distinct()
        .groupBy("host", "path", "text", "size", "words").agg(*_vector()).filter("pages > 1"), "texts")
    texts = repeated.filter(F.col("pages") >= F.lit(SUPPORT))
    above = nodes.select("host", "pages", "times", "vector", "all_chars", F.col("path").alias("node"))
    classes = (texts.join(above, ["host", "pages", "times", "vector"])
               .filter((F.col("path") == F.col("node")) | F.startswith("path", F.concat("node", F.lit("/"))))
               .groupBy("host", "vector", "times", "all_chars", "text", "size").agg(F.lit(None))
               .groupBy("host", "vector", "times", "all_chars").agg(
                   F.sum(F.col("size") * F.col("times")).alias("fixed"), F.collect_list("text").alias("texts")))
    fixed = (classes.filter(F.col("fixed") <= F.col("all_chars") * F.lit(COPIES))
             .groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("texts")))
    # Classes on a part of the pages. A passage that several hosts repeat is no host's template.
    single = repeated.groupBy("text").agg(F.min("host").alias("host"), F.max("host").alias("_last")).filter("host = _last")
    turning = (texts.join(single.select("host", "text"), ["host", "text"]).join(hosts, "host")
               .filter(F.col("pages") >= F.col("all_pages") * F.lit(TURNS))
               .groupBy("host", "pages", "times", "vector").agg(F.sum("words").alias("words"), F.collect_list("text").alias("texts"))
               .filter(F.col("words") >= F.lit(CLASS_WORDS))
               .groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("turning")))
    return hosts.select("host").join(slots, "host", "left").join(fixed, "host", "left").join(turning, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Null or empty html gives an empty text. Unclosed tags and a page that breaks off are read as far as they go. A page
    keeps what the best of its host's slots holds on it beside the template (texts of classes on a part of the pages only
    go where they are at most half of the page's text; more are near copies); without a slot, its articles, or all blocks
    that are neither outside the article nor part of the template (if that leaves none, the template's too, then
    what only names put outside, at last all blocks). Urls without a host share the empty host.
    """
    return _chosen(pages).withColumn("text", F.coalesce(
        F.array_join(F.transform("_best", lambda b: b["text"]), "\n"), F.lit(""))).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _chosen(pages: DataFrame) -> DataFrame:
    """The blocks that remain of each page as ``_best``, and ``_way``: what chose them."""
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    parsed = settle(per_text(rows, parse, PARSED, "html").drop("html")
                    .withColumn("_page", F.xxhash64("blocks", "paths")), "blocks")
    known = settle(templates(parsed), "templates").withColumnRenamed("host", "_host")
    at = parsed.join(known, F.col("host") == F.col("_host"), "left")
    texts = F.coalesce("texts", F.array().cast("array<bigint>"))
    slot = F.get(F.filter("slots", lambda s: F.exists("paths", lambda p: p["path"] == s)), F.lit(0))
    inner = F.filter("blocks", lambda b: ~b["outside"])
    free = F.filter("_inner", lambda b: ~F.array_contains("_texts", F.xxhash64(b["path"], b["text"])))
    turns = F.filter("_free", lambda b: F.array_contains("turning", F.xxhash64(b["path"], b["text"])))
    turned = F.aggregate(turns, F.lit(0).cast("long"), lambda n, b: n + F.length(b["text"]))
    still = F.filter("_free", lambda b: ~F.array_contains("turning", F.xxhash64(b["path"], b["text"])))
    rest = F.when(F.col("turning").isNotNull() & (turned <= F.col("total") * F.lit(MOST_TURNS)), still).otherwise(F.col("_free"))
    articles = F.filter("_free", lambda b: b["main"])
    in_slot = F.filter("_free", lambda b: F.col("_slot").isin(b["path"], b["role"])
                       | F.startswith(b["path"], F.concat("_slot", F.lit("/")))
                       | F.startswith(b["role"], F.concat("_slot", F.lit("/"))))
    by_tag = F.filter("blocks", lambda b: ~b["outside"] | b["named"])
    ways = {"slot": "_in_slot", "article": "_articles", "free": "_free", "inner": "_inner", "named": "_by_tag"}
    best, way = F.col("blocks"), F.lit("all")
    for name, column in reversed(ways.items()):
        some = F.coalesce(F.size(column), F.lit(0)) > 0
        best, way = F.when(some, F.col(column)).otherwise(best), F.when(some, F.lit(name)).otherwise(way)
    return (at.withColumn("_texts", texts).withColumn("_slot", slot).withColumn("_inner", inner)
            .withColumn("_free", free).withColumn("_free", rest).withColumn("_articles", articles).withColumn("_in_slot", in_slot)
            .withColumn("_by_tag", by_tag).withColumn("_best", best).withColumn("_way", way))
