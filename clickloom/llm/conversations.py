"""Conversation structure repair: the cheapest edits after which roles alternate.

A conversation is read as a sequence of symbols, one per row: the initial of its role and its first fault. Repairing
is a shortest path through four states (nothing yet, after system, after user, after assistant). What a sequence
does to the states is a 4 x 4 matrix of (cost, audit) under min-plus: lower cost first, then the lesser audit. Audits
of one cost over the same rows are never a prefix of each other, as edits of other letters cost something else, so the
lesser one stays the lesser whatever follows, and the matrices can be multiplied in any grouping.

Re-Pair finds pairs of symbols that stand next to each other often, over all conversations, and makes each a rule. A rule
has one matrix, the product of its two parts, with audits as ropes over theirs, evaluated once from the bottom up
and shared by all conversations. A conversation is then a short sequence of rules.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clickloom.llm.common import SPACE, per_text, settle

#: Rules of the grammar, and how many of them are picked from one count of the pairs.
RULES = 96
RULES_A_ROUND = 16
#: Occurrences that make a pair a rule.
LEAST_PAIRS = 4

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: A symbol is the letter at ROLES.index(initial) * len(FAULTS) + FAULTS.index(fault); other initials count as x.
ROLES = "suax"
FAULTS = ("none", "blank", "duplicate", "truncated")
SYMBOLS = "ABCDEFGHIJKLMNOP"
#: Rules are letters from here on.
FIRST_RULE = 0x4E00


# Rows to symbols

def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32 of ``conv_id:turn`` modulo 20, with nulls in role and text as one space.

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks out, 3 repeats it, 4 makes the
    role user. Dropped rows stay with ``_dropped`` set, so that no conversation is lost.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                       F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault == 0).alias("_dropped"), F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("_copy"))


def whole(rows: DataFrame) -> DataFrame:
    """Rows as they are, in the shape of ``damaged``."""
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("_dropped"), F.lit(1).alias("_copy"))


#: The order of a conversation's rows, nulls first: rows of one turn by role, then by a hash of role and text.
ORDER = ["turn", "role", "_h0", "_h1", "_copy"]


def hashed(rows: DataFrame) -> DataFrame:
    return rows.select("*", *[F.xxhash64(F.lit(i), "role", "text").alias(f"_h{i}") for i in range(2)])


def laid_out(rows: DataFrame) -> DataFrame:
    """What is needed of rows beside their text, in ranges of (conversation, ORDER), with ``_at``, which grows in that
    order. Texts stay where they are."""
    # Without the white space at its end a text shows its last character.
    bare = F.regexp_replace("text", f"[{SPACE}]+$", "")
    initial = F.substring("role", 1, 1)
    narrow = hashed(rows).select(
        "conv_id", *ORDER, "_dropped", F.when(initial.isin(*ROLES[:3]), initial).otherwise("x").alias("_role"),
        (bare == "").alias("_blank"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("_ended"))
    return settle(narrow.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
                  .withColumn("_at", F.monotonically_increasing_id()), "conversations")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def symbols(layout: DataFrame) -> DataFrame:
    """``conv_id, _at, _symbol`` of laid out rows that are not dropped."""
    rows = layout.filter(~F.col("_dropped"))
    # Only messages said more than once in a conversation: the first of each.
    first = rows.groupBy("conv_id", "_h0", "_h1").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        F.col("conv_id").alias("_conv"), F.col("_h0").alias("_g0"), F.col("_h1").alias("_g1"), "_first")
    found = rows.join(first, _same("conv_id", "_conv") & (F.col("_h0") == F.col("_g0"))
                      & (F.col("_h1") == F.col("_g1")), "left")
    fault = F.when(F.col("_blank"), 1).when(F.col("_at") > F.col("_first"), 2).when(~F.col("_ended"), 3).otherwise(0)
    number = (F.instr(F.lit(ROLES), F.col("_role")) - 1) * len(FAULTS) + fault
    return found.select("conv_id", "_at", F.substring(F.lit(SYMBOLS), number + 1, F.lit(1)).alias("_symbol"))


def sequences(layout: DataFrame) -> DataFrame:
    """``conv_id, symbols``: a letter for each row, also for conversations all of whose rows are dropped.

    The letters of one range are put together first, so no task holds more than a range's rows, or a conversation's letters.
    """
    letters = layout.filter("_dropped").select("conv_id", "_at", F.lit("").alias("_symbol")).unionByName(symbols(layout))

    def joined(at: str, text: str) -> Column:
        listed = F.sort_array(F.collect_list(F.struct(at, text)))
        return F.array_join(F.transform(listed, lambda x: x[text]), "")

    pieces = letters.groupBy("conv_id", F.shiftright("_at", 33).alias("_range")).agg(joined("_at", "_symbol").alias("_piece"))
    return pieces.groupBy("conv_id").agg(joined("_range", "_piece").alias("symbols"))


# Grammar

def grammar(sequences: DataFrame, rules: int = RULES, least: int = LEAST_PAIRS) -> list[str]:
    """Pairs of symbols, each the rule of the next letter from FIRST_RULE on; later rules may hold earlier ones.

    Re-Pair over the different sequences, weighed by how many conversations have them. Each round counts all adjacent
    pairs and takes the commonest. The driver holds at most ``RULES_A_ROUND`` pairs a round; the choice of rules changes
    no result, only how much work conversations share.
    """
    texts = settle(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")).filter(F.length("symbols") > 1), "sequences")
    found: list[str] = []
    text = F.col("symbols")
    while len(found) < rules:
        pairs = texts.select("n", text.alias("t")).filter(F.length("t") > 1).select(
            "n", F.explode(F.sequence(F.lit(1), F.length("t") - 1)).alias("i"), "t").groupBy(
            F.expr("substring(t, i, 2)").alias("pair")).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        best = [r["pair"] for r in pairs.orderBy(F.desc("n"), "pair").limit(min(RULES_A_ROUND, rules - len(found))).collect()]
        if not best:
            break
        for pair in best:
            text = F.replace(text, F.lit(pair), F.lit(chr(FIRST_RULE + len(found))))
            found.append(pair)
    return found


class Rope:
    """Text put together without copying; read out once, when it is compared or returned."""

    __slots__ = ("_left", "_right", "_text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self._text, self._left, self._right = text, left, right

    def __add__(self, other: Rope) -> Rope:
        return Rope(None, self, other)

    def text(self) -> str:
        if self._text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is None:
                    todo += (rope._right, rope._left)
                else:
                    parts.append(rope._text)
            self._text = "".join(parts)
            self._left = self._right = None
        return self._text


#: (cost, audit) by state before and after; absent where there is no way.
Matrix = dict[tuple[int, int], tuple[int, Rope]]

_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
# States in which a message of the role may follow, and the state after it.
_STEPS = {"s": {_NOTHING: _SYSTEM}, "u": dict.fromkeys((_NOTHING, _SYSTEM, _ASSISTANT), _USER), "a": {_USER: _ASSISTANT}}
_EMPTY = Rope("")


def _keep_best(into: Matrix, key: tuple[int, int], cost: int, audit: Rope) -> None:
    old = into.get(key)
    if old is None or cost < old[0] or (cost == old[0] and old[1] is not audit and audit.text() < old[1].text()):
        into[key] = (cost, audit)


def product(a: Matrix, b: Matrix) -> Matrix:
    """What ``a`` and then ``b`` do."""
    found: Matrix = {}
    for (p, q), (cost, audit) in a.items():
        for (r, s), (more, rest) in b.items():
            if q == r:
                _keep_best(found, (p, s), cost + more, audit + rest)
    return found


def _unit() -> Matrix:
    return {(q, q): (0, _EMPTY) for q in range(4)}


def _inserts() -> Matrix:
    """Any number of inserted messages; no cheapest way needs more than the states there are."""
    one = {(p, q): (INSERT, Rope("I")) for role in "ua" for p, q in _STEPS[role].items()}
    found = _unit()
    for _ in range(4):
        longer = product(found, one)
        for key, (cost, audit) in longer.items():
            _keep_best(found, key, cost, audit)
    return found


def row_matrix(symbol: str) -> Matrix:
    """Messages put in before a row, and then what becomes of the row."""
    number = SYMBOLS.index(symbol)
    role, fault = ROLES[number // len(FAULTS)], FAULTS[number % len(FAULTS)]
    step: Matrix = {(q, q): (DELETE, Rope("D")) for q in range(4)}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        for p, q in _STEPS.get(role, {}).items():
            _keep_best(step, (p, q), more, Rope("K"))
        for new in "ua":
            for p, q in _STEPS[new].items():
                if new != role:
                    _keep_best(step, (p, q), REROLE + more, Rope("R"))
    return product(_inserts(), step)


class Grammar:
    """Rules with their matrices, each evaluated once."""

    def __init__(self, rules: list[str]):
        self.rules = [(pair, chr(FIRST_RULE + n)) for n, pair in enumerate(rules)]
        self.matrix = {s: row_matrix(s) for s in SYMBOLS}
        for pair, letter in self.rules:
            self.matrix[letter] = product(self.matrix[pair[0]], self.matrix[pair[1]])
        self.last = _inserts()

    def repaired(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of the cheapest way to nothing at all, or to an assistant's message at the end."""
        for pair, letter in self.rules:
            symbols = symbols.replace(pair, letter)
        parts = [self.matrix[s] for s in symbols]
        if parts:  # only the first state matters from the start on
            parts[0] = {k: v for k, v in parts[0].items() if k[0] == _NOTHING}
        while len(parts) > 1:
            parts = [product(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        done = product(parts[0] if parts else {(_NOTHING, _NOTHING): (0, _EMPTY)}, self.last)
        best: Matrix = {}
        for (_, q), (cost, audit) in done.items():
            if q in (_NOTHING, _ASSISTANT):
                _keep_best(best, (0, 0), cost, audit)
        cost, audit = best[0, 0]
        return cost, audit.text()


def with_repairs(sequences: DataFrame, rules: list[str]) -> DataFrame:
    """``sequences`` with ``cost`` and ``audit``."""
    def of(texts: pd.Series) -> pd.DataFrame:
        known = _grammar(tuple(rules))
        found = {s: known.repaired(s) for s in texts.unique()}
        return pd.DataFrame([found[s] for s in texts], columns=["cost", "audit"])

    return per_text(sequences, of, "cost long, audit string", "symbols")


@lru_cache(maxsize=4)
def _grammar(rules: tuple[str, ...]) -> Grammar:
    return Grammar(list(rules))


# Repaired conversations

class _Reader:
    """Applies one conversation's audit to its rows as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        # An odd number of messages starts with the system's.
        self.role = "system" if (len(audit) - audit.count("D")) % 2 else "user"
        self.digest = hashlib.sha256()

    def _next(self) -> str:
        """The role at this place; the one after it follows."""
        role, self.role = self.role, "assistant" if self.role == "user" else "user"
        self.place += 1
        return role

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Messages put in before the next row, or at the end."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._next(), ""

    def messages(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Messages put in before a row, and what becomes of it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            new = self._next()
            yield role if edit == "K" else new, text


def _streamed(rows: DataFrame, repairs: DataFrame, schema: StructType, each: Callable) -> DataFrame:
    """Runs ``each`` over conversations in order: a conversation's audit comes first, then its rows one at a time.

    A conversation goes to one task, as its hash can only be taken in order, but memory holds one Arrow batch and one audit
    however long it is.
    """
    body = hashed(rows.filter(~F.col("_dropped"))).withColumn("_body", F.lit(True))
    heads = repairs.select("conv_id", "audit", F.lit(False).alias("_body"))
    together = (heads.unionByName(body, allowMissingColumns=True).repartition("conv_id")
                .sortWithinPartitions("conv_id", "_body", *ORDER).select("conv_id", "_body", "role", "text", "audit"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: pa.Schema | None = None
        reader, conv = None, None

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            columns = zip(*made, strict=True) if made else [()] * len(types)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t.type) for c, t in zip(columns, types, strict=True)], schema=types)

        for batch in batches:
            if types is None:
                types = pa.schema([(c, batch.schema.field("conv_id").type if c == "conv_id" else
                                    pa.int64() if c == "position" else pa.string()) for c in schema.names])
            made = []
            for conv_id, is_row, role, text, audit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not is_row:
                    if reader is not None:
                        made += each(conv, reader)
                    reader, conv = _Reader(audit), conv_id
                else:
                    made += each(conv, reader, role, text)
            yield batch_of(made)
        if reader is not None:
            yield batch_of(each(conv, reader))

    return together.mapInArrow(read, schema)


def digests(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: hash of the repaired messages ``role:text`` joined by line feeds."""
    def each(conv, reader: _Reader, *row: str) -> list[tuple]:
        at = reader.place
        for role, text in (reader.messages(*row) if row else reader.inserted()):
            reader.digest.update(f"{chr(10) if at else ''}{role}:{text}".encode("utf-8", "replace"))
            at += 1
        return [] if row else [(conv, reader.digest.hexdigest())]

    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), StructField("repaired_sha256", StringType())])
    return _streamed(rows, repairs, schema, each)


def judged(sequences: DataFrame, layout: DataFrame) -> DataFrame:
    """``sequences`` with gaps and the numbers of blank, duplicate and truncated rows and of illegal steps."""
    text = F.col("symbols")

    def having(fault: str) -> Column:
        letters = "".join(SYMBOLS[r * len(FAULTS) + FAULTS.index(fault)] for r in range(len(ROLES)))
        return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")

    initials = F.translate(text, SYMBOLS, "".join(r * len(FAULTS) for r in ROLES))
    legal = F.regexp_count(initials, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    turns = layout.filter(~F.col("_dropped")).groupBy(F.col("conv_id").alias("_conv")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("_gaps"))
    return sequences.join(turns, _same("conv_id", "_conv"), "left").select(
        *sequences.columns, F.coalesce("_gaps", F.lit(0).cast("long")).alias("gaps"), *[having(f).alias(f) for f in FAULTS[1:]],
        F.when(F.length(text) > 1, F.length(text) - 1 - legal).otherwise(0).cast("long").alias("illegal"))


def solved(layout: DataFrame) -> DataFrame:
    """``conv_id, symbols, cost, audit`` of laid out rows, written once."""
    found = settle(sequences(layout), "symbols")
    return settle(with_repairs(found, grammar(found)), "repairs")


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``damaged`` or ``whole``): its faults, the cheapest repair and its hash.

    Rows are taken by turn (nulls first), then in ORDER. A null conv_id is one conversation. The first fault of a row
    counts: blank, duplicate (role and text stood in the conversation before), truncated (no mark ends it). A role
    counts by its first character; one that is empty or none of s, u, a fits nowhere and is reroled or deleted. A
    conversation without rows has zeros, an empty audit and the hash of the empty string. An empty table gives an empty one.
    """
    layout = laid_out(rows)
    repairs = solved(layout)
    hashes = digests(rows, repairs).withColumnRenamed("conv_id", "_id")
    return judged(repairs, layout).join(hashes, _same("conv_id", "_id")).select(
        "conv_id", "gaps", *FAULTS[1:], "illegal", "cost", "audit", "repaired_sha256")


def repaired_messages(rows: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the repaired conversations themselves, numbered from 0."""
    def each(conv, reader: _Reader, *row: str) -> list[tuple]:
        at = reader.place
        made = list(reader.messages(*row) if row else reader.inserted())
        return [(conv, at + n, *message) for n, message in enumerate(made)]

    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), StructField("position", LongType()),
                         StructField("role", StringType()), StructField("text", StringType())])
    return _streamed(rows, solved(laid_out(rows)), schema, each)
