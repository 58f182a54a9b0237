"""The operators as queries over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from spoorlens.llm import byte_bpe, decontamination, filter_audit, licenses, packing, quality_rules, sharding, simhash, spelling, substring_dedup, suffix_array, toxicity, url_filter
from spoorlens.llm.common import ship, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


# Measurements and bits of the quality rules, from their definitions: one row per word,
# windows by lead(), and a word repeats if one of the five windows over it does.
QUALITY_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
),
words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
windows AS (
  SELECT rid, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)
),
again AS (
  SELECT rid, i, CAST(w4 IS NOT NULL AND count(*) OVER (PARTITION BY rid, w, w1, w2, w3, w4) > 1 AS INT) AS r FROM windows
),
covered AS (
  SELECT rid, max(r) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM again
),
repeats AS (SELECT rid, CAST(sum(c) AS BIGINT) AS n FROM covered GROUP BY rid),
measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_capitals
  FROM split LEFT JOIN repeats USING (rid)
),
ledger AS (
  SELECT *, CAST(
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 60 * word_chars THEN 64 ELSE 0 END AS INT) AS failed_bits
  FROM measured
)
"""


@query(QUALITY_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM ledger
""")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(documents(spark, folder)))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.fails("failed_bits", "base").alias("base_failed"), "kept", "failed_bits",
    )


# The given lists: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query(r"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path
  FROM rests
),
rules AS (
  SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS r(verdict, rhost, rpath)
),
fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS n
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND n = 1
""")
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, folder).select("doc_id", "text"), shards=8)
    return placed.select(
        "doc_id", "size", F.crc32(text_of()).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder), shingle=3, radius=3)


@query()
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder)).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query()
def op2_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(~toxicity.is_held_out())
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query()
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_windows(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query()
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.matches(documents(spark, folder), items)


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return licenses.scan(docs, licenses.fit(licenses.negative_lines(docs)))


@query()
def op13_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(documents(spark, folder)).select("doc_id", "ids")
    return byte_bpe.decode(encoded).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
split AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN s.doc_id > first THEN 'E' ELSE '' END AS fails
  FROM split s JOIN firsts USING (t) LEFT JOIN marks m ON s.doc_id = m.doc_id
),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
seen AS (
  SELECT *, contains(fails, own) AS here, length(translate(fails, before, '')) < length(fails) AS earlier FROM counted, steps
),
audit AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN here AND earlier THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND NOT earlier THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY ALL
),
shares AS (SELECT part, own, sum(removed) AS shapley FROM audit GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM audit JOIN shares USING (part, own)
""")
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filter_audit.audit(documents(spark, folder), labels)


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder)).select("word", "form", "root", "n", "n_near", "form_n")
