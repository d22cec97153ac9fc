"""Language of a page by Bayes: text likelihoods, the declared language, and what its host and address suffix usually hold.

The text speaks through hashed character n-grams and words, with likelihoods per language counted on a bounded labelled
sample and a flat likelihood for text of no known language ("und"). A first posterior from the text alone is summed per
host, per address suffix (the last label of the host) and over all rows by grouped aggregation. A host's prior is its sum
without the row itself, smoothed towards its suffix, which is smoothed towards the whole. A declared language counts by
how often rows of each language declare it. All factors are multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdshort.llm.batches import slices
from holdshort.llm.shipping import ship, shipped
from holdshort.llm.subwords import Subwords, WordSums
from holdshort.operators.spread import spread_join
from holdshort.session import freeze

UNKNOWN = "und"
HTML_DECLARED = r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b"
HTML_MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z0-9#]{1,10};"
URL_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


@dataclass
class Settings:
    """`max_rows` bounds the labelled rows that text likelihoods are counted on, taken evenly from the languages."""

    buckets: int = 1 << 15
    ngrams: tuple[int, ...] = (1, 2, 3)
    max_rows: int = 4000
    smoothing: float = 0.5
    #: features after which more text adds no more evidence, since features of one text depend on each other
    evidence: float = 200.0
    host_weight: float = 5.0
    suffix_weight: float = 20.0
    least_probability: float = 0.5

    @property
    def subwords(self) -> Subwords:
        return Subwords(self.buckets, self.ngrams, fold_case=True)


@dataclass
class Model:
    """Log-likelihood of each bucket (rows) in each language (columns); the last column is that of no language."""

    settings: Settings
    languages: list[str]
    likelihoods: np.ndarray
    _words: WordSums | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": None}

    def evidence(self, text: str | None) -> tuple[list[float], int]:
        """Log-likelihood of the whole text per language and for none, damped for long texts; its number of words."""
        words = (text or "").split()
        if not words:
            return [0.0] * self.likelihoods.shape[1], 0
        if self._words is None:
            self._words = WordSums(self.settings.subwords, self.likelihoods)
        total = self._words.total(words)
        damped = total[:-1] * min(1.0, self.settings.evidence / total[-1])
        return damped.tolist(), len(words)


def fit(docs: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text",
        language: str = "lang") -> Model:
    """Count features of labelled texts. Null labels do not count, nor do labels that are empty or "und".

    Rows are taken by a hash of key and text, the same number of each language as far as there are so many; a taken text
    counts as a whole. At most languages x buckets numbers reach the driver.
    """
    settings = settings or Settings()
    named = docs.select(F.col(language).alias("_lang"), F.xxhash64(key, text).alias("_hash"), F.col(text).alias("_text"))
    named = named.where(F.col("_lang").isNotNull() & ~F.col("_lang").isin("", UNKNOWN))
    # a language with many rows is thinned by its hash to a few times what is wanted before rows are ranked
    sizes = named.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * settings.max_rows) / F.col("_n"))
    thinned = spread_join(named.select("_lang", "_hash"), sizes, ["_lang"]).where(
        F.shiftrightunsigned("_hash", 1) / float(1 << 63) < share)
    turn = F.row_number().over(Window.partitionBy("_lang").orderBy("_hash"))
    sample = (thinned.withColumn("_turn", turn).where(F.col("_turn") <= settings.max_rows)
              .orderBy("_turn", "_lang").limit(settings.max_rows).select("_lang", "_hash").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = held.setdefault(name, np.zeros(settings.buckets, dtype=np.int64))
                sums += settings.subwords.counts((value or "").split())
        for name, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(sums[at])})

    taken = named.join(F.broadcast(sample), ["_lang", "_hash"]).select("_lang", "_text")
    rows = (taken.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .toLocalIterator())
    counts: dict[str, np.ndarray] = {}
    for row in rows:
        counts.setdefault(row.lang, np.zeros(settings.buckets))[row.bucket] = row.n
    languages = sorted(counts)
    columns = [np.log((counts[x] + settings.smoothing) / (counts[x].sum() + settings.smoothing * settings.buckets))
               for x in languages]
    columns.append(np.full(settings.buckets, -np.log(settings.buckets)))
    return Model(settings, languages, np.stack(columns, axis=1))


def text_evidence(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace the text by `evidence` (log-likelihoods, languages then "und") and `n_words`; other columns stay."""
    sent, at = ship(rows.sparkSession, model), rows.columns.index(text)
    kept = [c for c in rows.columns if c != text]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(sent)
        for batch in slices(batches):
            found = [fitted.evidence(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns) if i != at],
                 pa.array([e for e, _ in found], pa.list_(pa.float64())), pa.array([n for _, n in found], pa.int64())],
                [*kept, "evidence", "n_words"])

    schema = rows.select(*kept, F.array(F.lit(0.0)).alias("evidence"), F.lit(0).cast("long").alias("n_words")).schema
    return rows.mapInArrow(fill, schema)


def _softmax(logs: Column) -> Column:
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _sums(posterior: str, n: int) -> list[Column]:
    return [F.sum(F.col(posterior)[i]).alias(f"s{i}") for i in range(n)]


def identify(rows: DataFrame, model: Model, key: str = "key") -> DataFrame:
    """key, lang, probability, reliable and n_words for rows with key, text, declared and host.

    `declared` is a language code or null, `host` a host name or null (its suffix is the part after the last dot); both
    count without regard to case. A row without a declared language, or host, does without that factor. A text without
    words gets what the rest says, but is not reliable; a row is reliable if its text has words, its language is not
    "und" and its probability reaches `least_probability`. Repeated rows are judged one by one, and ties go to the first
    language by name. Sums cover all rows. The host table is joined so that one host may hold any share of the rows;
    declared codes are cut to three letters, so that their table has at most 20,000 rows.
    """
    settings, names = model.settings, [*model.languages, UNKNOWN]
    n = len(names)
    code = F.lower(F.regexp_extract(F.coalesce("declared", F.lit("")), r"^\s*([A-Za-z]{2,3})\b", 1))
    read = rows.select(
        F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"), F.when(code != "", code).alias("declared"),
        F.lower(F.when(F.col("host") != "", F.col("host"))).alias("host"))
    seen = freeze(text_evidence(read, model).withColumn("posterior", _softmax(F.col("evidence"))))
    worded = seen.where(F.col("n_words") > 0)

    hosts = worded.where(F.col("host").isNotNull()).groupBy("host").agg(*_sums("posterior", n))
    hosts = freeze(hosts.withColumn("suffix", F.substring_index("host", ".", -1)))
    whole = worded.agg(*_sums("posterior", n)).first()
    total = sum(x or 0.0 for x in whole) or 1.0
    base = [((x or 0.0) + 1.0 / n) / (total + 1.0) for x in whole]
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(f"s{i}").alias(f"t{i}") for i in range(n)])
    all_t = sum((F.col(f"t{i}") for i in range(n)), F.lit(0.0))
    suffixes = suffixes.select("suffix", F.array(*[
        (F.col(f"t{i}") + settings.suffix_weight * base[i]) / (all_t + settings.suffix_weight) for i in range(n)]).alias("suffix_prior"))
    hosts = spread_join(hosts, suffixes, ["suffix"], "left").select(
        "host", F.array(*[F.col(f"s{i}") for i in range(n)]).alias("host_sums"), "suffix_prior")

    said = worded.where(F.col("declared").isNotNull()).groupBy("declared").agg(*_sums("posterior", n))
    said_all = said.agg(*[F.sum(f"s{i}").alias(f"a{i}") for i in range(n)], F.count(F.lit(1)).alias("codes")).first()
    codes = (said_all["codes"] or 0) + 1
    said = said.select("declared", F.array(*[
        F.log((F.col(f"s{i}") + 1.0 / codes) / ((said_all[f"a{i}"] or 0.0) + 1.0)) for i in range(n)]).alias("declaring"))

    joined = spread_join(seen, hosts, ["host"], "left").join(F.broadcast(said), "declared", "left")
    own = F.when(F.col("n_words") > 0, F.lit(1.0)).otherwise(0.0)
    prior = []
    for i in range(n):
        rest = F.greatest(F.lit(0.0), F.col("host_sums")[i] - own * F.col("posterior")[i])
        rows_of_host = F.greatest(F.lit(0.0), F.aggregate("host_sums", F.lit(0.0), lambda a, x: a + x) - own)
        smoothed = (rest + settings.host_weight * F.col("suffix_prior")[i]) / (rows_of_host + settings.host_weight)
        prior.append(F.log(F.coalesce(smoothed, F.lit(base[i]))))
    logs = F.array(*[F.col("evidence")[i] + prior[i] + F.coalesce(F.col("declaring")[i], F.lit(0.0)) for i in range(n)])
    fused = joined.withColumn("fused", logs).withColumn("fused", _softmax(F.col("fused")))
    best = F.array_max("fused")
    return fused.select(
        "key", F.element_at(F.array(*map(F.lit, names)), F.array_position("fused", best).cast("int")).alias("lang"),
        best.alias("probability"), "n_words").withColumn(
        "reliable", (F.col("n_words") > 0) & (F.col("lang") != UNKNOWN) & (F.col("probability") >= settings.least_probability))
