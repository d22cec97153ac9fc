"""Hashed features of words and their n-grams, and sums of their weights over texts."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np

#: Words that a worker remembers; when the bound is reached, the memory starts anew. It does not change results.
WORDS_KEPT = 200_000
WORD_LENGTH_KEPT = 64
#: Words of a text that are looked at together.
WORDS_AT_ONCE = 100_000


@dataclass(frozen=True)
class Subwords:
    """Features of a word: itself and the n-grams of its UTF-8 bytes between end marks, hashed to buckets.

    The end marks alone are no features, since every word has them.
    """

    buckets: int
    ngrams: tuple[int, ...]
    fold_case: bool

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place of the word in the list, bucket) of all features of some words, all words at once."""
        marked = [f"<{w.lower() if self.fold_case else w}>".encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(x) for x in marked], dtype=np.int64)
        data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(marked)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes from here to the end of the word
        owners = [np.arange(len(marked))]
        codes = [np.fromiter(map(crc32, marked), dtype=np.uint64, count=len(marked)) << np.uint64(8)]
        gram = np.zeros_like(data)
        for n in range(1, max(self.ngrams, default=0) + 1):
            shifted = np.zeros_like(data)
            shifted[:max(0, len(data) - n + 1)] = data[n - 1:]
            gram = gram * np.uint64(257) + shifted + np.uint64(1)
            if n in self.ngrams:
                inside = left >= n if n > 1 else (left > 1) & (left < sizes[owner])
                owners.append(owner[inside])
                codes.append(gram[inside] << np.uint64(8) | np.uint64(n))
        mixed = np.concatenate(codes) * np.uint64(0x9E3779B97F4A7C15)
        return np.concatenate(owners), ((mixed >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def counts(self, words: list[str]) -> np.ndarray:
        """How often each bucket occurs in the words of a text."""
        out, often = np.zeros(self.buckets, dtype=np.int64), Counter(words)
        distinct = list(often)
        for start in range(0, len(distinct), WORDS_AT_ONCE):
            part = distinct[start:start + WORDS_AT_ONCE]
            owner, bucket = self.features(part)
            np.add.at(out, bucket, np.array([often[w] for w in part], dtype=np.int64)[owner])
        return out


class WordSums(dict):
    """Sums over texts of the weights of their features. Word -> row of a growing matrix with the sums of its features'
    weights and their number."""

    def __init__(self, subwords: Subwords, weights: np.ndarray):
        super().__init__()
        self.subwords, self.weights, self.used = subwords, weights, 0
        self.matrix = np.empty((1 << 14, weights.shape[1] + 1))

    def learn(self, words: list[str]) -> None:
        owner, bucket = self.subwords.features(words)
        while self.used + len(words) > len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.empty_like(self.matrix)])
        rows = self.matrix[self.used:self.used + len(words)]
        for i in range(self.weights.shape[1]):
            rows[:, i] = np.bincount(owner, self.weights[bucket, i], minlength=len(words))
        rows[:, -1] = np.bincount(owner, minlength=len(words))
        self.update(zip(words, range(self.used, self.used + len(words))))
        self.used += len(words)

    def total(self, words: list[str]) -> np.ndarray:
        """Sums of the weights' columns, then the number of features."""
        out = np.zeros(self.matrix.shape[1])
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start:start + WORDS_AT_ONCE]
            if self.used > WORDS_KEPT:
                self.clear()
                self.used = 0
            new = [w for w in set(part) if w not in self]
            if new:
                self.learn(new)
            out += self.matrix[list(map(self.__getitem__, part))].sum(0)
            for word in new:
                if len(word) > WORD_LENGTH_KEPT:
                    del self[word]
        return out
