"""SimHash fingerprints, and groups of those that differ in few bits, found through a Golay code.

Fingerprints link at three or fewer differing bits. Of four blocks of 16 bits one is then equal, and of the two halves of
the other 48 bits one differs in a single bit at most. From each half one bit is left out, and the other 23 are decoded
with the perfect Golay code (23, 12): every 23-bit word lies within three bits of exactly one codeword, and within four
bits of one or six. Two words that differ in one bit at most share a codeword, namely the nearest one of either.
So (block, its value, half, codeword), with one or six codewords each, are keys under which every link meets.

Distinct fingerprints are grouped under their keys and compared in numpy; a group gives a spanning forest of its links and
not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.llm.batches import slices
from holdshort.llm.components import components
from holdshort.operators.spread import spread_join
from holdshort.session import freeze

BITS, BLOCK, HALF = 64, 16, 24
WORD = 23
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0b110001110101
MAX_BITS = 3
#: Shingles whose bits are summed in bytes before the sums are widened, and shingles that are held at once.
BYTE_ROWS, SHINGLES_HELD = 255, 255 * 256
#: Groups up to this size are compared pair by pair, larger ones by growing a forest.
SMALL_GROUP = 32
#: Groups above this size are cut once more, by pieces of their fingerprints.
LARGE_GROUP = 8192


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").view(np.uint64).reshape(len(hashes), 8)
    return np.add.reduceat(bits, np.arange(0, len(bits), BYTE_ROWS), axis=0).view(np.uint8).sum(0, dtype=np.int64)


def fingerprint(data: bytes | None, words: int = 3, distinct: bool = False, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of a whole text in UTF-8: a bit is set if more than half of the shingles' hashes set it.

    A-Z are lowered; words are what white space of ASCII parts; a text with fewer words is one shingle, one without words
    has fingerprint zero. Repeated shingles count each time, or once if `distinct`.
    """
    from xxhash import xxh64_intdigest

    found = (data or b"").lower().split()
    if not found:
        return 0
    shingles = list(map(b" ".join, zip(*[found[i:] for i in range(words)]))) or [b" ".join(found)]
    if distinct:
        shingles = list(set(shingles))
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(shingles), SHINGLES_HELD):
        part = shingles[start:start + SHINGLES_HELD]
        ones += _bit_counts(np.fromiter(map(xxh64_intdigest, part, repeat(seed)), dtype=np.uint64, count=len(part)))
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view(np.int64)[0])


class Golay:
    """Keys of 23-bit words: the 12 information bits of every codeword within four bits, the nearest first."""

    def __init__(self):
        def remainder(word: int) -> int:
            for shift in range(WORD - 12, -1, -1):
                if word >> (shift + 11) & 1:
                    word ^= GENERATOR << shift
            return word

        self.low = np.array([remainder(w) for w in range(1 << 12)], dtype=np.int64)
        self.high = np.array([remainder(w << 12) for w in range(1 << 11)], dtype=np.int64)
        errors: list[list[int]] = [[] for _ in range(1 << 11)]
        for weight in range(5):
            for at in combinations(range(WORD), weight):
                pattern = sum(1 << i for i in at)
                errors[remainder(pattern)].append(pattern)
        self.count = np.array([len(e) for e in errors])
        self.errors = np.array([e + [0] * (6 - len(e)) for e in errors], dtype=np.int64)

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Six codewords per word, and which of them count."""
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words[:, None] ^ self.errors[syndrome]) >> 11, np.arange(6) < self.count[syndrome][:, None]


def _without_block(fingerprints: np.ndarray, block: int) -> np.ndarray:
    """The 48 bits outside one block, as whole numbers."""
    at = np.uint64(BLOCK * block)
    below = fingerprints & np.uint64((1 << BLOCK * block) - 1)
    return (below | (fingerprints >> at >> np.uint64(BLOCK) << at)).astype(np.int64)


def link_keys(fingerprints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for all keys of all fingerprints, given as uint64."""
    keys, owners = [], []
    for block in range(BITS // BLOCK):
        value = (fingerprints >> np.uint64(BLOCK * block)).astype(np.int64) & 0xFFFF
        rest = _without_block(fingerprints, block)
        for half in range(2):
            found, valid = code.keys(rest >> (HALF * half) & ((1 << WORD) - 1))
            keys.append((((2 * block + half) << 28 | value << 12)[:, None] | found)[valid])
            owners.append(np.repeat(fingerprints, valid.sum(1)))
    return np.concatenate(keys), np.concatenate(owners)


def _forest(group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of one group."""
    out, left = [], group
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            node = waiting.pop()
            near = np.bitwise_count(left ^ node) <= MAX_BITS
            if near.any():
                reached = left[near]
                out.append((np.full(len(reached), node), reached))
                waiting.extend(reached)
                left = left[~near]
    return out


def group_links(keys: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints with equal keys; rows are sorted by key, and groups are whole."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    out = []
    few = np.repeat(sizes <= SMALL_GROUP, sizes)
    small_keys, small = keys[few], fingerprints[few]
    for step in range(1, min(SMALL_GROUP, len(small))):
        same = small_keys[step:] == small_keys[:-step]
        if not same.any():
            break
        a, b = small[:-step][same], small[step:][same]
        near = np.bitwise_count(a ^ b) <= MAX_BITS
        out.append((a[near], b[near]))
    for start, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        group = np.unique(fingerprints[start:start + size])
        if len(group) <= LARGE_GROUP:
            out += _forest(group)
            continue
        # the group has one block in common; of four pieces of the other bits a link has one in common, too
        rest = _without_block(group, int(keys[start]) >> 29)
        for piece in range(4):
            values = rest >> (12 * piece) & 0xFFF
            order = np.argsort(values, kind="stable")
            for part in np.split(group[order], np.flatnonzero(np.diff(values[order])) + 1):
                out += _forest(part)
    if not out:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) among the distinct values of column fp that connect all fingerprints at most three bits apart."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            keys, owners = link_keys(batch.column(0).to_numpy().view(np.uint64), code)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], ["key", "fp"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def linked() -> pa.RecordBatch:
            a, b = group_links(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys, owners = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            # the last group may go on in the next batch
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                held.append((keys[:cut], owners[:cut]))
                yield linked()
                held.clear()
            held.append((keys[cut:], owners[cut:]))
        if held:
            yield linked()

    distinct = fingerprints.select("fp").distinct()
    keyed = distinct.mapInArrow(spread, "key bigint, fp bigint")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(join, "a bigint, b bigint").distinct()


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, distinct: bool = False, name: str = "fp") -> DataFrame:
    """Replace the text column by the fingerprint of the whole text; other columns stay. A null text is an empty one."""
    at, kept = docs.columns.index(text), [c for c in docs.columns if c != text]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(x, words, distinct) for x in batch.column(at).cast(pa.binary()).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], [*kept, name])

    return docs.mapInArrow(fill, docs.select(*kept, F.lit(0).cast("long").alias(name)).schema)


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """key, fp and component_id, the smallest key among all rows that fingerprints link, directly or through others.

    One row per input row. Texts that are null or have no words have fingerprint zero and link like others. Rows with
    equal texts have equal fingerprints and meet before any search; null keys count in no minimum. Other columns are
    left out.
    """
    marked = freeze(fingerprints(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", words))
    nodes = freeze(marked.groupBy("fp").agg(F.min("_key").alias("least")))
    roots = components(links(nodes))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp")
    least = spread_join(members, nodes, ["fp"]).groupBy("root").agg(F.min("least").alias("component_id"))
    linked = spread_join(members, least, ["root"]).select("fp", "component_id")
    of = spread_join(nodes, linked, ["fp"], "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return spread_join(marked, of, ["fp"]).select(F.col("_key").alias(key), "fp", "component_id")
