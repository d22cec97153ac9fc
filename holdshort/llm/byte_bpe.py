"""Byte-level byte-pair encoding by backtracking, and its inverse.

A pre-token is mapped to Latin-1, so that one character stands for one byte, and one pass of an Aho-Corasick automaton
over the vocabulary finds the longest token at every byte. The encoder goes from left to right, takes the longest token,
and falls back to its next shorter prefix token whenever the token before does not tolerate it. Two neighbours tolerate
each other if, while both grow from single bytes, no merge across their border comes first; the answers are remembered.
A position whose tokens all failed is never entered again, which bounds the work by the length of the pre-token. The
result equals that of merging pairs by rank.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdshort.llm.batches import slices, with_columns
from holdshort.llm.shipping import ship, shipped
from holdshort.llm.units import space_units

#: Bounds of what a worker remembers; when one is reached, the memory starts anew. They do not change results.
UNITS_KEPT = 300_000
PAIRS_KEPT = 400_000
UNIT_LENGTH_KEPT = 64

NEVER = 1 << 60


def merged_parts(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Plain byte-pair merging of a short byte string, stopped when `until` parts are left."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > until:
        best = min(((ranks[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in ranks), default=None)
        if best is None:
            break
        at = best[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Tokens by id, with what the encoder needs to know about each; small enough to send to every task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # the two halves of each token's last merge; a token that merging never yields stands only for a whole pre-token
        halves = {t: merged_parts(t, ranks, 2) for t in ranks}
        self.made = {t: h for t, h in halves.items() if len(h) < 2 or len(h) == 2 and h[0] + h[1] == t}
        self.shorter = [-1] * len(self.tokens)
        for token in self.made:
            for size in range(len(token) - 1, 0, -1):
                if token[:size] in self.made:
                    self.shorter[ranks[token]] = ranks[token[:size]]
                    break

    @property
    def encoder(self) -> Encoder:
        """One encoder per process: a worker that is used again goes on with what it remembers."""
        if not hasattr(self, "_encoder"):
            self._encoder = Encoder(self)
        return self._encoder

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_encoder"}

    @classmethod
    def read(cls, spark: SparkSession, path: str, pattern: str) -> Vocabulary:
        """A rank file: a token in base 64 and its rank per line. The driver reads it; tasks get it by broadcast."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if len(ranks) > 1_000_000:
            raise ValueError("a vocabulary of over a million tokens is too large to send to every task")
        return cls(ranks, pattern)


class Encoder:
    """Encodes texts with one vocabulary, inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        import regex

        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        self.sizes = [len(t) for t in vocabulary.tokens]
        self.automaton = ahocorasick.Automaton()
        for token in vocabulary.made:
            self.automaton.add_word(token.decode("latin-1"), vocabulary.ranks[token])
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.edges: tuple[dict, dict] = {}, {}

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one edge of a token while it grows, each with the rank of the merge that ends it."""
        known = self.edges[side].get(token)
        if known is None:
            part, ended, known = self.vocabulary.tokens[token], NEVER, []
            while True:
                known.append((part, ended))
                if len(part) == 1:
                    break
                ended, part = self.vocabulary.ranks[part], self.vocabulary.made[part][side]
            known = self.edges[side][token] = known[::-1]
        return known

    def grow_apart(self, lefts: list[tuple[bytes, int]], rights: list[tuple[bytes, int]]) -> bool:
        """Whether two tokens side by side both grow to the end before a merge joins them; of equal ranks the left wins."""
        rank_of, i, j = self.vocabulary.ranks.get, 0, 0
        while True:
            (left, left_ends), (right, right_ends) = lefts[i], rights[j]
            joined = rank_of(left + right, NEVER)
            if joined < left_ends and joined <= right_ends and joined < NEVER:
                return False
            if left_ends == right_ends == NEVER:
                return True
            if left_ends <= right_ends:
                i += 1
            else:
                j += 1

    def tolerated(self, left: int, right: int) -> bool:
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        known = self.grow_apart(self.edge(left, 1), self.edge(right, 0))
        self.pairs[left << 32 | right] = known
        return known

    def pre_token(self, data: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return [whole]
        sizes, shorter, known, n = self.sizes, self.vocabulary.shorter, self.pairs.get, len(data)
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token  # matches that start at one byte come in the order of their ends
        out: list[int] = []
        failed = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if not failed[at + sizes[token]]:
                    if last < 0:
                        break
                    fits = known(last << 32 | token)
                    if fits or fits is None and self.tolerated(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += sizes[token]
                last, token = token, longest[at]
            elif out:
                failed[at] = 1
                at -= sizes[last]
                token = shorter[out.pop()]
                last = out[-1] if out else -1
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def unit(self, unit: str) -> tuple[int, ...]:
        pieces, out = self.pieces, []
        for piece in self.split(unit):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.pre_token(piece.encode())
                if len(piece) <= UNIT_LENGTH_KEPT:
                    if len(pieces) >= UNITS_KEPT:
                        pieces.clear()
                    pieces[piece] = tuple(ids)
            out.extend(ids)
        return tuple(out)

    def text(self, text: str) -> list[int]:
        units, out = self.units, []
        for unit in space_units(text):
            ids = units.get(unit)
            if ids is None:
                ids = self.unit(unit)
                if len(unit) <= UNIT_LENGTH_KEPT:
                    if len(units) >= UNITS_KEPT:
                        units.clear()
                    units[unit] = ids
            out.extend(ids)
        return out


def _lists(values: array, offsets: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(np.frombuffer(values, dtype=np.int32)))


def _added(df: DataFrame, columns: dict[str, str], fill) -> DataFrame:
    clash = columns.keys() & set(df.columns)
    if clash:
        raise ValueError(f"the input already has {sorted(clash)}")
    return with_columns(df, fill, **{c: F.lit(None).cast(kind) for c, kind in columns.items()})


def _decoded(ids: list[int] | None, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids)) if ids else b""


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", data: str | None = None,
           batch: int = 64) -> DataFrame:
    """Add a column of token ids of the whole text; a null or empty text has no tokens.

    Rows, other columns and their order stay; a column `ids` must not exist yet. A text of any length is encoded as a
    whole. Rows of a batch are encoded in slices of `batch` to bound the memory of long texts. With `data` the ids are
    decoded again in the same pass, into a column of that name.
    """
    sent = ship(df.sparkSession, vocabulary)
    at = df.columns.index(text)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = shipped(sent).encoder, shipped(sent).tokens
        for rows in slices(batches, batch):
            values, offsets, bytes_ = array("i"), [0], []
            for value in rows.column(at).to_pylist():
                found = encoder.text(value) if value else []
                values.extend(found)
                offsets.append(len(values))
                if data:
                    bytes_.append(_decoded(found, tokens))
            more = [pa.array(bytes_, pa.binary())] if data else []
            yield pa.RecordBatch.from_arrays([*rows.columns, _lists(values, offsets), *more], [*rows.schema.names, *[f"a{i}" for i in range(len(new))]])

    new = {ids: "array<int>"} | ({data: "binary"} if data else {})
    return _added(df, new, fill)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", data: str = "data", batch: int = 64) -> DataFrame:
    """Add the bytes that the ids stand for; null or no ids give no bytes. An id outside the vocabulary is an error."""
    sent = ship(df.sparkSession, vocabulary)
    at = df.columns.index(ids)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shipped(sent).tokens
        for rows in slices(batches, batch):
            found = [_decoded(x, tokens) for x in rows.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.binary())], [*rows.schema.names, "a0"])

    return _added(df, {data: "binary"}, fill)
