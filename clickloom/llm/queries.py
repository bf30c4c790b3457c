"""The training-data operators as registered queries, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bloom_cascade,
    conversations,
    decontaminate,
    external_shuffle,
    importance,
    language,
    line_dedup,
    mixing,
    pii,
    pivots,
    revisits,
    simhash,
    templates,
)
from clickloom.llm.common import table

SHARDS = 8

# The url rules asked for.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
#: Hosts that the method blocks, subdomains included, where no rule decides.
LISTED = ("adult-x.example.com", "cheap-pills.example.net", "spam-farm.example.org")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).drop("text")


def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.withColumn("size", external_shuffle.text_bytes(F.col("text")))
    placed = external_shuffle.external_shuffle(sized, "size", SHARDS).withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS rules(key, verdict)")
    listed = spark.sql(f"SELECT explode(array{LISTED}) AS key")
    return bloom_cascade.judge(table(spark, sf_dir, "pages"), rules, listed)


def op4_template_deduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(table(spark, sf_dir, "pages"))


def web_records(pages: DataFrame) -> DataFrame:
    """Four records of each page: its full response and three not-modified revisits, one of them from before, one by
    a weak validator and one by date alone."""
    minute = F.coalesce("page_id", F.lit(0)) * 60 + 1_700_000_000
    tag = F.concat(F.lit('"'), F.crc32(F.coalesce("html", F.lit("")).cast("binary")).cast("string"), F.lit('"'))
    stamp = F.date_format(F.timestamp_seconds(minute), "yyyy-MM-dd HH:mm:ss")
    page = F.col("page_id").cast("string")

    def record(letter: str, days: int, kind: str, **headers) -> DataFrame:
        pairs = [x for k, v in headers.items() for x in (F.lit(k.replace("_", "-")), v)]
        return pages.select(
            F.concat(F.lit(letter), page).alias("record_id"), "url",
            F.timestamp_seconds(minute + days * 86_400).alias("fetched"), F.lit(kind).alias("kind"),
            F.create_map(*pairs).alias("headers"),
            (F.md5("html") if kind == "response" else F.lit(None).cast("string")).alias("digest"))

    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    return (record("a", 0, "response", ETag=tag, Last_Modified=stamp, Content_Length=size, Age=F.lit("0"))
            .union(record("b", -1, "revisit", ETag=tag, Age=F.lit("1")))
            .union(record("c", 30, "revisit", ETag=F.concat(F.lit("W/"), tag), Age=F.lit("2"), Content_Length=F.lit("0")))
            .union(record("d", 60, "revisit", Last_Modified=stamp, Expires=F.lit("0"))))


def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(web_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    listed = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("headers", F.array_join(listed, ";"))


def op6_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("shard_words", F.array_join(F.col("shard_words").cast("array<string>"), ","))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out(docs)))
    rows = docs.select("doc_id", "text", held_out(docs).alias("held_out"))
    return language.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.without_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_pii, op2_external_shuffle, op3_bloom_cascade, op4_template_deduction, op5_revisit_resolution,
             op6_sainte_lague, op7_decontamination, op8_language_id, op9_simhash, op10_pivot_index,
             op11_line_dedup, op12_importance_resampling, op13_conversation_repair)
    return {f.__name__: f for f in found}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP3 = f"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN ('.' || host) LIKE '%.adult-x.example.com' OR ('.' || host) LIKE '%.cheap-pills.example.net'
    OR ('.' || host) LIKE '%.spam-farm.example.org' THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

_OP7 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM dw JOIN g USING (n, gram)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

_OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
m AS (SELECT a, least(a, min(b)) AS least_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least_id, vec_id) AS component_id,
  coalesce(least_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.a = vec_id
"""


_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT r, i, w[i] AS line, translate(trim(w[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{_UPPER}', '{_LOWER}') AS k FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
g AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
m AS (SELECT l.*, g.k IS NOT NULL AS gone FROM l LEFT JOIN g USING (k))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d JOIN m USING (r) GROUP BY r, doc_id
"""


def llm_sql() -> dict[str, str]:
    return {"op3_bloom_cascade": _OP3, "op7_decontamination": _OP7, "op10_pivot_index": _OP10,
            "op11_line_dedup": _OP11}
