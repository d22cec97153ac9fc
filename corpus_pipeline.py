"""A corpus job in stages; each stage is written as Parquet and read again as the next one's documents.

Languages that cannot be told and texts of low quality go, one of each group of near copies stays, sources are mixed to
their weights, and what is left is encoded. Stages that judge rows one by one number them first, so equal rows and rows
without an id are told apart; every stage takes null and empty texts, empty tables and further columns, whatever their
names. All stages but the last hand on the columns of the documents; the last keeps doc_id and source alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdshort.llm import byte_bpe, golay_simhash, language_id, mixing, quality_classifier
from holdshort.llm.rows import few, numbered
from holdshort.session import freeze, scratch_path


def _columns(docs: DataFrame) -> list[Column]:
    """The columns of a table, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _free(docs: DataFrame) -> str:
    """A start of column names that the table does not use."""
    start = "_stage"
    while any(c.lower().startswith(start) for c in docs.columns):
        start += "_"
    return start


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told reliably from text, declared language and source."""
    row = f"{_free(docs)}_row"
    rows = numbered(docs, row)
    found = language_id.identify(rows.select(
        F.col(row).alias("key"), "text", F.col("lang").alias("declared"), F.col("source").alias("host")), language_id.fit(docs))
    return rows.join(few(found.where(~F.col("reliable")).select(F.col("key").alias(row))), row, "left_anti").select(_columns(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, holds for good ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, F.lit(True))
    score = f"{_free(docs)}_score"
    return quality_classifier.score(docs, model, name=score).where(F.col(score) >= 0.5).select(_columns(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that SimHash links: three-word shingles, at most three differing bits."""
    row = f"{_free(docs)}_row"
    rows = numbered(docs, row)
    found = golay_simhash.grouped(rows.select(row, "text"), key=row)
    surplus = found.where(F.col(row) != F.col("component_id")).select(row)
    return rows.join(few(surplus), row, "left_anti").select(_columns(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one that a source's budget cuts keeps its first words."""
    start = _free(docs)
    row, keep = f"{start}_row", f"{start}_words"
    rows = numbered(docs, row)
    size = mixing.n_words(F.col("text"))
    mixed = mixing.mix(rows.select(
        F.col("doc_id").alias("key"), "source", size.alias("size"),
        mixing.quality_weight(F.col("text"), size).alias("weight"), F.col(row)), carry=[row])
    drawn = freeze(mixed.select(row, F.col("size").alias("_size"), F.col("taken").alias("_taken")).where("_taken > 0"))
    whole = F.when(F.col("_taken") >= F.col("_size"), F.floor(F.col("_taken") / F.col("_size"))).otherwise(0).cast("int")
    rest = (F.col("_taken") - whole * F.col("_size")).cast("int")
    # copies of a row, each with its number of words; null stands for the whole text
    words = F.concat(F.array_repeat(F.lit(None).cast("int"), whole),
                     F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    taken = rows.join(drawn.select(row, F.explode(words).alias(keep)), row)
    parts = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)
    cut = F.when(F.col(keep).isNull(), F.col("text")).otherwise(F.array_join(F.slice(parts, 1, F.col(keep)), ""))
    return taken.withColumn("text", cut).select(_columns(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    vocabulary = byte_bpe.Vocabulary.read(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode(docs.select("doc_id", "source", "text"), vocabulary, data="data")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        (F.col("data") == text).alias("decodes"))


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near copies", near_copy_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: The classifier, the fingerprints and the encoding have no SQL; tests/llm/test_pipeline.py compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
