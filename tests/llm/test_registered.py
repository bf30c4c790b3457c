"""Registered training-data queries on the smallest tables: SQL where there is some, brute force otherwise."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from oracle import connect, rows_of_spark, rows_of_sql

from clickloom.llm import simhash
from clickloom.llm.queries import llm_queries, llm_sql

QUERIES = entry.queries()
NATIVE = ("op2_external_shuffle", "op3_bloom_cascade", "op6_sainte_lague", "op11_line_dedup")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in llm_queries()) == list(range(1, 14))
    assert set(llm_queries()) | {"pipeline"} <= set(QUERIES)
    assert set(llm_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    names, expected = rows_of_sql(connect(sf_dir), llm_sql()[name])
    assert sorted(result.columns) == names
    assert rows_of_spark(result) == expected


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_personal_data(spark, sf_dir, documents):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    kinds = list(patterns)

    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = {r["doc_id"]: r for r in QUERIES["op1_pii"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    for d in documents:
        base = sorted((m.start(), kinds.index(k), m.end()) for k, p in patterns.items()
                      for m in re.finditer(p, d["text"] or "") if good(k, m[0]))
        listed = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        row = found[d["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in kinds] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(listed) <= set(row["spans"].split(",")) | ({""} if not listed else set())


def test_shuffle(spark, sf_dir, documents):
    rows = QUERIES["op2_external_shuffle"](spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in documents)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {r["law"] for r in rows} == {"rows"}
    again = QUERIES["op2_external_shuffle"](spark, sf_dir).collect()
    assert Counter(rows) == Counter(again)
    in_shard = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])) if r["shard"] == 0]
    assert in_shard != sorted(in_shard)


def test_shuffle_moves_whole_documents(spark, sf_dir, monkeypatch):
    from clickloom.llm import external_shuffle
    given, own = [], external_shuffle.external_shuffle
    monkeypatch.setattr(external_shuffle, "external_shuffle", lambda docs, *a: given.append(docs.columns) or own(docs, *a))
    QUERIES["op2_external_shuffle"](spark, sf_dir)
    assert set(spark.read.parquet(f"{sf_dir}/documents.parquet").columns) <= set(given[0])


def test_main_text(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op4_template_deduction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        source = pages[r["page_id"]]["html"]
        inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        inner = re.sub(r"<[^>]*$", "", inner)
        parts = re.split(r"</?(?:p|h1)>", inner)
        import html
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_mixing(spark, sf_dir, documents):
    rows = QUERIES["op6_sainte_lague"](spark, sf_dir).collect()
    size = {d["doc_id"]: len(words(d["text"])) for d in documents}
    source = {d["doc_id"]: d["source"] for d in documents}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    stopped = set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in stopped)
        share = sum(weight[s] for s in names if s not in stopped)
        target = {s: 2 * total[s] if s in stopped else left * weight[s] / share for s in names}
        over = {s for s in names if target[s] > 2 * total[s] * (1 + 1e-12)}
        if not over:
            break
        stopped |= over
    taken = Counter()
    assert len(rows) == len(documents)
    for r in rows:
        own = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[own]
        assert r["target"] == pytest.approx(target[own], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[own] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 16 for s in names)
    assert Counter(rows) == Counter(QUERIES["op6_sainte_lague"](spark, sf_dir).collect())


def test_language(spark, sf_dir, documents):
    lang = {d["doc_id"]: d["lang"] for d in documents}
    rows = QUERIES["op8_language_id"](spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["rejected"] for r in rows]) < 0.01


def slow_fingerprint(text):
    own = words(ascii_lower(text))
    if not own:
        return 0
    hashes = [xxhash.xxh64(" ".join(own[i:i + 4]).encode(), seed=42).intdigest()
              for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_classes(items, linked):
    """The least id of each item's class; ``linked(i)`` yields the later items that i is linked with."""
    up = list(range(len(items)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(items)):
        for j in linked(i):
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    least = {}
    for i, own in enumerate(items):
        least[find(i)] = min(least.get(find(i), own), own)
    return [least[find(i)] for i in range(len(items))]


def test_simhash(spark, sf_dir, documents):
    prints = np.array([slow_fingerprint(d["text"]) for d in documents], np.uint64)
    ids = [d["doc_id"] for d in documents]
    least = slow_classes(ids, lambda i: np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1:]) <= 4) + i + 1)
    expected = Counter((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, least, strict=True))
    assert Counter(tuple(r) for r in QUERIES["op9_simhash"](spark, sf_dir).collect()) == expected
    assert len(set(least)) < len(ids)


def test_revisits(spark, sf_dir):
    from clickloom.llm.queries import web_records
    from clickloom.llm.revisits import KEPT_HEADERS
    records = web_records(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()

    def canonical(url):
        rest = re.sub("^.*?://", "", re.sub("#.*$", "", url))
        base, _, query = rest.partition("?")
        host, slash, path = base.partition("/")
        kept = sorted(p for p in query.split("&") if p and not re.match("(utm_[a-z]+|gclid|fbclid|ref)=", p))
        return host.lower() + (slash + path).rstrip("/") + ("?" + "&".join(kept) if kept else "")

    full = defaultdict(list)
    for r in records:
        if r["kind"] == "response":
            full[canonical(r["url"])].append(r)
    expected = {}
    for r in records:
        if r["kind"] != "revisit":
            continue
        mine = {k.lower(): v for k, v in r["headers"].items()}
        earlier = [x for x in full[canonical(r["url"])]
                   if (x["fetched"], x["record_id"]) < (r["fetched"], r["record_id"])]
        outcome, target, headers, digest = "missing", None, None, None
        if earlier:
            last = max(earlier, key=lambda x: (x["fetched"], x["record_id"]))
            theirs = {k.lower(): v for k, v in last["headers"].items()}
            if "etag" in mine:
                same = mine["etag"].removeprefix("W/") == theirs["etag"]
            else:
                same = mine["last-modified"] == theirs["last-modified"]
            outcome = "resolved" if same else "mismatch"
            if same:
                new = {k: v for k, v in mine.items() if k not in KEPT_HEADERS}
                headers = ";".join(f"{k}={v}" for k, v in sorted((theirs | new).items()))
                target, digest = last["record_id"], last["digest"]
        expected[r["record_id"]] = (canonical(r["url"]), outcome, target, digest, headers)
    rows = QUERIES["op5_revisit_resolution"](spark, sf_dir).collect()
    assert {r["record_id"]: (r["canonical_url"], r["outcome"], r["target_id"], r["digest"], r["headers"])
            for r in rows} == expected
    assert len({v[1] for v in expected.values()}) >= 2


def test_pipeline(spark, sf_dir, documents):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.settle(stage(spark, before, sf_dir), name)
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == before.columns
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    first = kept["language_id"].collect()
    prints = np.array([simhash.profile(d["text"]) for d in first], np.uint64)
    own = [d["doc_id"] for d in first]

    def near(i):
        apart = np.bitwise_count(prints[i] ^ prints[i + 1:]).astype(int)
        alike = (apart[:, 1:1 + simhash.FINGERPRINTS].min(axis=1) <= 4) & (apart[:, -2:].sum(axis=1) <= simhash.FAR)
        return np.flatnonzero(alike | (apart[:, 0] == 0)) + i + 1

    least = slow_classes(own, near)
    assert ids["near_duplicates"] == set(least)
    marked = {r["doc_id"]: r["contaminated"] for r in QUERIES["op7_decontamination"](spark, sf_dir).collect()}
    assert ids["decontamination"] == {i for i in ids["near_duplicates"] if not marked[i]}
    assert kept["sharding"].count() == kept["mixing"].count()
    assert ids["sharding"] <= ids["decontamination"]


def bucket_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text))


def test_resampling(spark, sf_dir, documents):
    def buckets(text):
        w = bucket_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    own = {d["doc_id"]: buckets(d["text"]) for d in documents}
    s = Counter(b for found in own.values() for b in found)
    t = Counter(b for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for b in buckets(r["text"]))
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10000)]

    def noise(i):
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    weight = {i: sum(gain[b] for b in found) for i, found in own.items()}
    score = {i: weight[i] + noise(i) for i in own}
    can = sorted((d["doc_id"] for d in documents if len(bucket_words(d["text"])) >= 20), key=lambda i: (-score[i], i))
    rank = {i: n + 1 for n, i in enumerate(can[:5 * len(can) // 100])}
    rows = QUERIES["op12_importance_resampling"](spark, sf_dir).collect()
    assert {tuple(r) for r in rows} == {(i, len(own[i]), weight[i], score[i], rank.get(i)) for i in own}
    assert rank


def cheapest(letters):
    """Cost and audit over (initial, fault) rows, by trying every output length and edit."""
    best = None
    blocked = ("blank", "duplicate")
    for out in range(0, 2 * len(letters) + 4):
        if out == 1:
            continue
        roles = ("s" if out % 2 else "") + "ua" * (out // 2)
        ways = {(0, 0): (0, "")}
        for i in range(len(letters) + 1):
            for j in range(out + 1):
                if (i, j) not in ways:
                    continue
                cost, audit = ways[i, j]
                steps = []
                if j < out and roles[j] != "s":
                    steps.append((i, j + 1, 2, "I"))
                if i < len(letters):
                    role, fault = letters[i]
                    steps.append((i + 1, j, 3, "D"))
                    if j < out and fault not in blocked:
                        more = fault == "truncated"
                        if role == roles[j]:
                            steps.append((i + 1, j + 1, more, "K"))
                        elif roles[j] != "s":
                            steps.append((i + 1, j + 1, 2 + more, "R"))
                for a, b, extra, letter in steps:
                    way = (cost + extra, audit + letter)
                    if (a, b) not in ways or way < ways[a, b]:
                        ways[a, b] = way
        if (len(letters), out) in ways and (best is None or ways[len(letters), out] < best):
            best = ways[len(letters), out]
    return best, roles


def test_repair(spark, sf_dir):
    given = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        given[r["conv_id"]].append(r)
    rows = {r["conv_id"]: r for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert set(rows) == set(given)
    blank = "\x20\x09\x0a\x0b\x0c\x0d"
    for conv, own in given.items():
        after = []
        for r in sorted(own, key=lambda r: r["turn"]):
            fault = zlib.crc32(f"{conv}:{r['turn']}".encode()) % 20
            role, text = "user" if fault == 4 else r["role"], r["text"]
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            after += [(r["turn"], role, text)] * {0: 0, 3: 2}.get(fault, 1)
        letters, seen = [], set()
        for _, role, text in after:
            bare = text.strip(blank)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            letters.append((role[0], fault))
        row, turns = rows[conv], [a[0] for a in after]
        (cost, audit), _ = cheapest(letters)
        assert (row["cost"], row["audit"]) == (cost, audit)
        assert [row[f] for f in ("blank", "duplicate", "truncated")] == [
            sum(f == x for _, f in letters) for x in ("blank", "duplicate", "truncated")]
        assert row["illegal"] == sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(letters, letters[1:]))
        assert row["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        made, rest = [], iter(after)
        kept = len(audit) - audit.count("D")
        roles = (["system"] if kept % 2 else []) + ["user", "assistant"] * (kept // 2)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(rest)
            if edit != "D":
                made.append(f"{role if edit == 'K' else roles[len(made)]}:{text}")
        assert row["repaired_sha256"] == hashlib.sha256("\n".join(made).encode()).hexdigest()
