"""Supervised subword embeddings: a text is the mean of learned vectors, a softmax over it gives the label.

Every word, every character n-gram of the word between end marks, and every word that equals the one before it is hashed
to one of `buckets` vectors. The mean of a text's vectors goes through a linear layer and a softmax; vectors and layer
are trained together by stochastic gradient descent in numpy. The layer is linear in the mean, so for scoring each bucket
is reduced to one number and a word to the sum over its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.llm.batches import slices, with_columns
from holdshort.llm.shipping import ship, shipped
from holdshort.llm.subwords import Subwords, WordSums


@dataclass
class Settings:
    """Sizes and rates of the fit. `max_rows` bounds the labelled rows that it learns from."""

    buckets: int = 1 << 16
    dimensions: int = 16
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 12
    rate: float = 0.5
    max_rows: int = 2500
    seed: int = 7

    @property
    def subwords(self) -> Subwords:
        return Subwords(self.buckets, self.ngrams, fold_case=False)


#: The bucket that counts words which equal the word before them.
REPEAT = 0


def repeats(words: list[str]) -> int:
    """Words that equal the word before them."""
    return sum(map(eq, words, islice(words, 1, None)))


def text_features(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    words = text.split()
    counts = settings.subwords.counts(words)
    counts[REPEAT] += repeats(words)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found]


@dataclass
class Model:
    """The logit of label 1 over label 0 of each bucket, and of a text without words."""

    settings: Settings
    logits: np.ndarray
    bias: float
    _words: WordSums | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": None}

    def score(self, text: str | None) -> float:
        """Probability of label 1; a null text is an empty one."""
        words, logit = (text or "").split(), self.bias
        if words:
            if self._words is None:
                self._words = WordSums(self.settings.subwords, self.logits[:, None])
            total, features = self._words.total(words)
            again = repeats(words)
            logit += (total + again * self.logits[REPEAT]) / (features + again)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Fit to (buckets, counts, label 0 or 1). Without both labels every text gets the share of label 1, or one half."""
    labels = [label for _, _, label in rows]
    share = (sum(labels) + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.dimensions)).astype(np.float32) / settings.dimensions
    layer = np.zeros((2, settings.dimensions), dtype=np.float32)
    bias = np.array([0.0, prior], dtype=np.float32)
    if len(set(labels)) < 2:
        return Model(settings, np.zeros(settings.buckets, dtype=np.float32), prior)
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for at in random.permutation(len(rows)):
            found, counts, label = rows[at]
            weights = (counts / max(1, counts.sum())).astype(np.float32)
            mean = weights @ vectors[found]
            logits = layer @ mean + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = error @ layer
            layer -= rate * np.outer(error, mean)
            bias -= np.float32(0.01 * rate) * error
            vectors[found] -= rate * np.outer(weights, back) * len(found)
    return Model(settings, vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, settings: Settings | None = None, key: str = "doc_id",
        text: str = "text", label: str = "quality") -> Model:
    """Learn from labelled rows for which `may_learn`, a condition on the key, holds.

    Of more than `max_rows` such keys those with the smallest hash are taken, which is the same sample in every run. A
    key with several labels has the smallest one; null labels and keys do not count; a text is used as a whole, reduced
    to its buckets in the tasks. At most max_rows x buckets numbers reach the driver.
    """
    settings = settings or Settings()
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & may_learn)
    one = known.groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_label"))
    sample = one.orderBy(F.xxhash64("_key"), "_key").limit(settings.max_rows)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    joined = texts.join(F.broadcast(sample), "_key").select("_key", "_label", F.coalesce("_text", F.lit("")).alias("_text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, marks, values = (batch.column(i).to_pylist() for i in range(3))
            for k, mark, value in zip(keys, marks, values):
                found, counts = text_features(value, settings)
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([str(k)]), "label": pa.array([mark], pa.int32()),
                    "found": pa.array([found.tolist()], pa.list_(pa.int32())),
                    "counts": pa.array([counts.tolist()], pa.list_(pa.int64()))})

    rows = joined.mapInArrow(extract, "k string, label int, found array<int>, counts array<bigint>").orderBy(
        F.xxhash64("k"), "k", F.xxhash64("found", "counts")).limit(settings.max_rows).toLocalIterator()
    return train([(np.array(r.found, dtype=np.int32), np.array(r.counts, dtype=np.int64), int(r.label > 0)) for r in rows],
                 settings)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1 for every whole text. Rows and other columns stay; `name` must be new.

    The model is sent to every task; its size is fixed by `buckets`.
    """
    if name in docs.columns:
        raise ValueError(f"the input already has a column {name}")
    sent, at = ship(docs.sparkSession, model), docs.columns.index(text)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(sent)
        for batch in slices(batches):
            scores = pa.array([fitted.score(x) for x in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "a0"])

    return with_columns(docs, fill, **{name: F.lit(0.0)})
