"""Line dedup, importance resampling and conversation repair on odd inputs."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import conversations, importance, line_dedup
from test_registered import ascii_lower, bucket_words, cheapest

LINES = "doc_id long, text string, n_lines string, keep string, lang string"


def texts(spark, *rows):
    return spark.createDataFrame([(i, t, "own", "own", None) for i, t in rows], LINES)


# Lines

def by_hand(rows, documents, keep_first=False):
    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0))
    split = [(t or "").split("\n") for _, t in rows]
    having = {}
    for n in order:
        for line in {key(x) for x in split[n]} - {""}:
            having.setdefault(line, []).append(n)
    found = []
    for n, lines in enumerate(split):
        kept, seen = [], set()
        for x in lines:
            first = keep_first and having.get(key(x), [n])[0] == n and key(x) not in seen
            seen.add(key(x))
            if len(having.get(key(x), ())) < documents or first:
                kept.append(x)
        found.append((rows[n][0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=str)


def test_lines_edges(spark):
    rng = random.Random(1)
    pool = ["Alike", " alike\t", "ALIKE", "", "  ", "two words", "É", "é"] + [f"line {i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 200)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "Alike\nother"), (102, "\n\n"), (103, "Alike")]
    rows.append((104, "\n".join(["Alike"] * 5000 + ["x" * 50_000] + ["two words"] * 3000)))
    for documents, ranges in ((2, 1), (10, 7), (20, 4)):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        found = line_dedup.without_lines(texts(spark, *rows), documents=documents)
        got = sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect()], key=str)
        assert got == by_hand(rows, documents)
        assert found.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped", "keep"]
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    first = line_dedup.without_lines(texts(spark, *rows), documents=2, keep_first=True).collect()
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in first], key=str) == by_hand(rows, 2, True)


def test_bitmaps_hold_the_lines_that_stay(spark):
    rows = [(i, "shared\n" + "\n".join(f"own {i} {n}" for n in range(150)) + "\nshared") for i in range(3)]
    for r in line_dedup.without_lines(texts(spark, *rows), documents=3).collect():
        gone = [i for i in range(152) if not r["keep"][i // 64] >> (i % 64) & 1]
        assert gone == [0, 151] and r["n_dropped"] == 2


def test_repeated_rows_count_as_documents(spark):
    rows = texts(spark, *[(7, "same\nsame")] * 3, (8, "other"))
    assert line_dedup.without_lines(rows, documents=3).filter("n_dropped = 2 and text = ''").count() == 3
    assert line_dedup.without_lines(rows, documents=4).filter("n_dropped = 0").count() == 4
    assert line_dedup.without_lines(rows.limit(0)).count() == 0


# Weights

def test_grams_from_prefixes():
    rng = np.random.default_rng(0)
    given = ["Hello, the wörld of ÄB c-3 ~ z9", None, "", "a" * 1000 + " b " + "é" * 70_000 + " ccc", "...", "one",
             " ".join(f"w{i}" for i in rng.integers(0, 1000, 3000)), "ÀÉ  x İ"]
    got = [[] for _ in given]
    for owner, crc in importance.Scanned(given).grams(3):
        for n, c in zip(owner, crc, strict=True):
            got[n].append(int(c))
    for text, found in zip(given, got, strict=True):
        w = bucket_words(text)
        assert found == [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_resampling_edges(spark):
    many = " ".join(f"word{i}" for i in range(30))
    rows = texts(spark, (1, None), (2, ""), (3, "?!"), (4, "few words"), *[(5, many)] * 60, (None, many + " more"), (6, "a " * 30_000))
    target = texts(spark, (1, "word1 word2 word3"), (2, None))
    found = importance.resample(rows, target).collect()
    assert len(found) == 66
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["n_features"] == by_id[i]["weight"] == 0 and by_id[i]["rank"] is None for i in (1, 2, 3))
    assert by_id[4]["n_features"] == 3 and by_id[4]["rank"] is None and by_id[6]["n_features"] == 89_997
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]
    assert importance.resample(rows, target, percent=100).filter("rank is not null").count() == 62
    assert importance.resample(rows.limit(0), target).count() == 0
    assert importance.resample(rows, target.limit(0)).filter("rank is not null").count() == 3
    chosen = importance.drawn_documents(rows.withColumn("rank", F.lit("own")), target)
    assert chosen.columns == [*rows.columns, "rank"] and chosen.filter("text is null").count() == 0


def test_ranks_follow_scores(spark):
    rng = random.Random(3)
    scored = spark.createDataFrame([(i, rng.randint(10, 30), 0, 0, rng.randint(-50, 50)) for i in range(2000)],
                                   "doc_id long, n_words long, n_features long, weight long, score long").repartition(5)
    rows = scored.collect()
    can = sorted((r for r in rows if r["n_words"] >= 20), key=lambda r: (-r["score"], r["doc_id"]))
    want = {r["doc_id"]: n + 1 for n, r in enumerate(can[:len(can) * 30 // 100])}
    assert {r["doc_id"]: r["rank"] for r in importance.drawn(scored, 30).collect() if r["rank"]} == want


# Turns

def tried(letters, bound):
    """Every sequence of edits up to a cost, tried out."""
    best = None
    todo = [(0, "", "", 0)]
    while todo:
        i, audit, roles, cost = todo.pop()
        if cost > bound:
            continue
        if i == len(letters) and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        for new in "ua":
            todo.append((i, audit + "I", roles + new, cost + 2))
        if i < len(letters):
            role, fault = letters[i]
            todo.append((i + 1, audit + "D", roles, cost + 3))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                todo.append((i + 1, audit + "K", roles + role, cost + more))
                todo += [(i + 1, audit + "R", roles + new, cost + 2 + more) for new in "ua"]
    return best


KINDS = list(itertools.product(conversations.ROLES, conversations.FAULTS))


def symbols_of(letters):
    return "".join(conversations.SYMBOLS[KINDS.index(x)] for x in letters)


def test_cheapest_edits_by_trying_all():
    plain = conversations.Grammar([])
    for letters in [*itertools.product(KINDS, repeat=1), *itertools.product(KINDS[::2], repeat=2), ()]:
        cost, audit = plain.repaired(symbols_of(letters))
        assert (cost, audit) == tried(letters, cost) == cheapest(letters)[0]
    rng = random.Random(2)
    for _ in range(60):
        letters = tuple(rng.choice(KINDS) for _ in range(3))
        cost, audit = plain.repaired(symbols_of(letters))
        assert (cost, audit) == tried(letters, cost)


def test_grammar_changes_no_result(spark):
    rng = random.Random(4)
    common = ["EIEI" * 3, "AEIEIH", "EIEIJEI"]
    rows = ["".join(rng.choice([*common, *conversations.SYMBOLS]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    rules = conversations.grammar(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "conv_id long, symbols string"))
    assert len(rules) > 20 and any(ord(c) >= conversations.FIRST_RULE for pair in rules for c in pair)
    plain, shared = conversations.Grammar([]), conversations.Grammar(rules)
    for r in rows:
        letters = [KINDS[conversations.SYMBOLS.index(x)] for x in r]
        assert shared.repaired(r) == plain.repaired(r) == cheapest(letters)[0]
    long = "".join(rng.choice(conversations.SYMBOLS) for _ in range(20_000))
    assert shared.repaired(long) == plain.repaired(long)


def turns(spark, *rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows],
                                 "conv_id long, turn long, role string, text string, cost string, _at string")


def test_repair_edges(spark):
    same = (4, 1, "user", "Hi.")
    rows = turns(
        spark, (None, None, None, None), (None, 1, "user", "Yes."), (1, None, "user", None), (1, 5, "assistant", "x."), (2, 0, "", "y."),
        (3, 0, "tool", "z."), same, same, same, (4, 2, "assistant", ""), (5, 0, "user", "long " * 200_000 + "."),
        *[(6, t, "assistant" if t % 2 else "user", f"{t}.") for t in range(3000)])
    found = {r["conv_id"]: r for r in conversations.report(conversations.whole(rows)).collect()}
    assert set(found) == {None, 1, 2, 3, 4, 5, 6}
    assert found[None]["blank"] == 1 and found[None]["illegal"] == 1 and found[None]["audit"] == "DKI"
    assert found[1]["gaps"] == 0 and found[1]["audit"] == "DIK" and found[2]["audit"] == found[3]["audit"] == "D"
    assert found[4]["duplicate"] == 2 and found[4]["blank"] == 1 and found[4]["cost"] == 11
    assert found[6]["cost"] == 0 and found[6]["audit"] == "K" * 3000
    message = "\n".join(f"{'assistant' if t % 2 else 'user'}:{t}." for t in range(3000))
    assert found[6]["repaired_sha256"] == hashlib.sha256(message.encode()).hexdigest()
    assert found[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    for shape in (conversations.whole, conversations.damaged):
        assert conversations.report(shape(rows.limit(0))).count() == 0
    assert conversations.report(conversations.damaged(rows)).count() == 7
    messages = conversations.repaired_messages(conversations.whole(rows)).filter("conv_id = 1").orderBy("position").collect()
    assert [(m["position"], m["role"], m["text"]) for m in messages] == [(0, "user", ""), (1, "assistant", "x.")]


def test_conversation_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = conversations.report(conversations.damaged(turns(spark, (gone, 0, "user", "a.")))).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
