"""One query per operator over the test tables; digests and flags of the results are derived here."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdshort.llm import (
    byte_bpe, golay_simhash, hilbert_shards, language_id, license_scan, mixing, pattern_packing, quality_classifier, quality_rules,
    source_divergence, spelling_variants, token_counts, top_k,
)
from holdshort.llm.registry import load, query
from holdshort.session import freeze, scratch_path


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = quality_classifier.fit(docs, load(spark, sf_dir, "labels"), fold != 1)
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_hilbert_shards")
def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = freeze(load(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.log2(F.octet_length(text) + 1.0).alias("size_log")))
    cut = hilbert_shards.shards(docs, ["lang", "source", "size_log"], ["text_crc32", "doc_id"], n_shards=8)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index")


OP3_SQL = r"""
WITH texts AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size FROM documents),
docs AS (
    SELECT doc_id, source, size, text,
           -ln((('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
               / 4503599627370496::DOUBLE)
           / (1::DOUBLE / (1::DOUBLE + 10::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>!', '')))::DOUBLE
                           / greatest(size, 1)::DOUBLE)) AS draw FROM texts),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sizes),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER earlier, 0)::DOUBLE)
              / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS level,
           2 * source_size::DOUBLE / weight::DOUBLE AS fill
    FROM weighed
    WINDOW earlier AS (ORDER BY 2 * source_size::DOUBLE / weight::DOUBLE, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT (SELECT level FROM levels WHERE level < fill ORDER BY fill, source NULLS LAST LIMIT 1) AS level),
targets AS (
    SELECT source, source_size, least(2 * source_size::DOUBLE, coalesce(found.level * weight, 2 * source_size::DOUBLE)) AS target
    FROM weighed, found),
budgets AS (
    SELECT *, round(target)::BIGINT AS budget,
           CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM targets),
placed AS (
    SELECT doc_id, d.size, source_size, target, budget, epochs,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, doc_id NULLS LAST, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken
FROM placed
"""


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    size = mixing.n_words(F.col("text"))
    rows = docs.select(F.col("doc_id").alias("key"), "source", size.alias("size"),
                       mixing.quality_weight(F.col("text"), size).alias("weight"))
    mixed = mixing.mix(rows)
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


OP4_SQL = """
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.n <> c.n AND len(q.vector) = len(c.vector)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op4_top_k", OP4_SQL)
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", top_k.quantised(F.col("embedding")).alias("vector"))
    return top_k.top_k(rows, F.col("vec_id") % 50 == 0, k=5)


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, vocabulary, data="data")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    store = scratch_path(spark, "token-counts")
    counted = token_counts.token_counts(load(spark, sf_dir, "documents"), tokenizer, store)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(load(spark, sf_dir, "documents"))
    pages = load(spark, sf_dir, "pages")
    rows = pages.select(
        F.col("page_id").alias("key"), F.regexp_replace("html", language_id.HTML_MARKUP, " ").alias("text"),
        F.regexp_extract("html", language_id.HTML_DECLARED, 1).alias("declared"),
        F.regexp_extract("url", language_id.URL_HOST, 1).alias("host"))
    return language_id.identify(rows, model).withColumnRenamed("key", "page_id")


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(load(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"), "quality")


@query("op9_license_scan", license_scan.oracle())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("known", " ").alias("known"),
                        "n_unknown")


@query("op10_simhash_golay")
def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golay_simhash.grouped(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op11_pattern_packing")
def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    packed = pattern_packing.pack(load(spark, sf_dir, "documents"), tokenizer, capacity=1024, end=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


OP12_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT row, lang, source, unnest(terms) AS term FROM texts),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
groups AS (SELECT DISTINCT lang, source FROM texts),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL),
cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n
    FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
priced AS (
    SELECT c.lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY c.lang, source)::HUGEINT + 5 * v) AS p,
           1 + (1000000000::HUGEINT * (lang_n + 5)) // (total + 5 * v) AS q
    FROM cells c JOIN langs l ON c.lang = l.lang),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", OP12_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(load(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group(spelling_variants.vocabulary(load(spark, sf_dir, "documents")))
