"""Token counts of texts, kept under the digests of the text and of the tokenizer.

A text that was counted before with the same tokenizer file is never encoded again: texts are reduced to their digests,
the digests are joined with the stored counts, only distinct texts without a count are encoded, and their counts are
appended to the store. Whoever changes the tokenizer file changes its digest and gets new counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdshort.llm.rows import few
from holdshort.llm.shipping import ship, shipped
from holdshort.llm.units import space_units
from holdshort.operators.spread import spread_join

STORE_SCHEMA = "text_digest binary, tokenizer_digest string, n_bytes bigint, n_tokens bigint"
#: Bounds of what a worker remembers; when one is reached, the memory starts anew. They do not change results.
UNITS_KEPT = 500_000
UNIT_LENGTH_KEPT = 64


class Tokenizer:
    """A tokenizer file that the driver reads and tasks get by broadcast; `.json` and `.model` name the library."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.data = file.read()
        if len(self.data) > 64 << 20:
            raise ValueError("a tokenizer file of over 64 MB is too large to send to every task")
        self.kind = path.rsplit(".", 1)[-1]
        if self.kind not in ("json", "model"):
            raise ValueError(f"no library for {path}")
        self.digest = hashlib.sha256(self.data).hexdigest()
        self.by_unit = self.kind == "json" and self._byte_level(json.loads(self.data))

    @staticmethod
    def _byte_level(spec: dict) -> bool:
        """Whether the tokens of a text are those of its units: no normaliser, and the byte-level pattern splits."""
        split = spec.get("pre_tokenizer") or {}
        special = "".join(x["content"] for x in spec.get("added_tokens", ()))
        plain = not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in spec.get("added_tokens", ()))
        return (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
                and split.get("use_regex", True) and plain and not any(map(str.isspace, special)))

    @property
    def counter(self) -> Counter:
        """One counter per process: a worker that is used again goes on with what it remembers."""
        if not hasattr(self, "_counter"):
            self._counter = Counter(self)
        return self._counter

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_counter"}


class Counter:
    """Counts tokens with the library, inside a task."""

    def __init__(self, tokenizer: Tokenizer):
        self.by_unit, self.units = tokenizer.by_unit, {}
        if tokenizer.kind == "json":
            from tokenizers import Tokenizer as Library

            library = Library.from_str(tokenizer.data.decode())
            library.no_truncation()
            library.no_padding()
            self.encode = lambda texts: map(len, library.encode_batch_fast(texts, add_special_tokens=False))
        else:
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_proto=tokenizer.data)
            self.encode = lambda texts: map(len, library.encode(texts, num_threads=1))

    def count(self, texts: list[str]) -> list[int]:
        """Counts of whole texts. Where units are independent, each is given to the library once."""
        if not self.by_unit:
            return list(self.encode(texts))
        cut = [space_units(t) for t in texts]
        known = self.units
        new = list({u for units in cut for u in units if u not in known})
        found = dict(zip(new, self.encode(new)))
        sums = [sum(known[u] if u in known else found[u] for u in units) for units in cut]
        if len(known) + len(found) > UNITS_KEPT:
            known.clear()
        known.update((u, n) for u, n in found.items() if len(u) <= UNIT_LENGTH_KEPT)
        return sums


def _counted(texts: DataFrame, tokenizer: Tokenizer, batch: int = 32) -> DataFrame:
    """(text_digest, text) -> a row of the store for each."""
    sent = ship(texts.sparkSession, tokenizer)
    names = [x.split()[0] for x in STORE_SCHEMA.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter, digest = shipped(sent).counter, shipped(sent).digest
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                rows = whole.slice(start, batch)
                values = [x or "" for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([digest] * len(values)),
                    pa.array([len(x.encode()) for x in values], pa.int64()), pa.array(counter.count(values), pa.int64()),
                ], names)

    return texts.mapInArrow(count, STORE_SCHEMA)


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The stored counts; None if there is no store yet."""
    try:
        return spark.read.schema(STORE_SCHEMA).parquet(store)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def token_counts(docs: DataFrame, tokenizer: Tokenizer, store: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_bytes and n_tokens of every row's whole text.

    Content is normalised only where that cannot change a count: a null text counts as the empty one, which has no
    tokens. Copies are encoded once. Repeated keys stay repeated; other columns are left out. Counts that are missing
    in `store`, a folder all executors share, are appended to it; a failed job leaves the store as it was, and two jobs
    that append the same digest do no harm, since readers take one row for each.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    digest = F.unhex(F.sha2(F.encode("_text", "UTF-8"), 256))

    def counts(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("tokenizer_digest") == tokenizer.digest)
        return rows.groupBy("text_digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))

    digests = named.select(F.col("_key"), digest.alias("text_digest"))
    missing = named.select(digest.alias("text_digest"), "_text")
    known = read_store(spark, store)
    if known is not None:
        # digests alone tell what is missing, so texts with a count stay where they are
        new = few(digests.select("text_digest").distinct().join(counts(known), "text_digest", "left_anti"))
        missing = spread_join(missing, new, ["text_digest"], "left_semi")
    # copies meet by digest within tasks first; then each text without a count is shuffled once
    distinct = missing.groupBy("text_digest").agg(F.first("_text").alias("_text"))
    _counted(distinct, tokenizer).write.mode("append").parquet(store)
    return spread_join(digests, counts(read_store(spark, store)), ["text_digest"], "left").select(
        F.col("_key").alias(key), "n_bytes", "n_tokens")
