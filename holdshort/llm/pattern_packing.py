"""Pack documents into sequences of fixed capacity by patterns of few lengths, fitted to the histogram of lengths.

Every pattern of up to three lengths that fills a sequence exactly is a column, and how often each pattern is used is
found by non-negative least squares against the counts of the lengths (Krell and others, 2021). The solution is rounded
down, the fit is repeated on what is left, and the residue is packed by best fit, longest first. Only the histogram, whose
size is the capacity whatever the input, is worked on by the driver. The outcome is a list of runs "the r-th document of
this length lies in this sequence at this place"; documents are numbered within their length by a distributed scan and
look their places up in the runs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.llm.batches import slices
from holdshort.llm.token_counts import Tokenizer
from holdshort.llm.units import space_units
from holdshort.operators.spread import number_rows
from holdshort.session import freeze

#: Fits, the first and those of what rounding left over, and steps of one fit.
ROUNDS, STEPS = 3, 300
#: Powers of the length by which errors of the fit are weighed; each is tried.
POWERS = (0.5, 1, 2, 4)
#: A composite key holds a length and the number of a document within it.
RANK_BITS = 40
#: Bounds of what a worker remembers; when one is reached, the memory starts anew. They do not change results.
UNITS_KEPT = 800_000
UNIT_LENGTH_KEPT = 64
#: New units that the library gets in one text.
UNITS_JOINED = 256


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of one to three of the given lengths, ascending, that add up to the capacity; zeros fill short rows."""
    has = np.zeros(capacity + 1, dtype=bool)
    has[lengths] = True
    lengths = np.flatnonzero(has)
    found = [np.array([[0, 0, capacity]])] if has[capacity] else []
    low = lengths[2 * lengths <= capacity]
    pairs = low[has[capacity - low]]
    found.append(np.stack([np.zeros_like(pairs), pairs, capacity - pairs], axis=1))
    for least in lengths[3 * lengths <= capacity]:
        middle = lengths[(lengths >= least) & (least + 2 * lengths <= capacity)]
        middle = middle[has[capacity - least - middle]]
        found.append(np.stack([np.full_like(middle, least), middle, capacity - least - middle], axis=1))
    return np.concatenate(found).astype(np.int64)


def least_squares(rows: np.ndarray, counts: np.ndarray, power: float = 0.5, steps: int = STEPS) -> np.ndarray:
    """Non-negative numbers of uses whose lengths come near the counts, by accelerated projected descent.

    `counts` is indexed by length. Errors on long documents weigh more, since one left over costs most of a sequence.
    """
    size = len(counts)
    weight = (np.arange(size) / max(size - 1, 1)) ** power
    scale = max(float(counts.max(initial=0)), 1.0)
    target = counts / scale

    def lengths_of(uses: np.ndarray) -> np.ndarray:
        return sum(np.bincount(column, uses, size) for column in rows.T)

    def pull(error: np.ndarray) -> np.ndarray:
        return sum(error[column] for column in rows.T)

    square = weight * weight
    probe = np.ones(len(rows))
    largest = 1.0
    for _ in range(30):
        probe = pull(square * lengths_of(probe))
        largest = float(np.linalg.norm(probe)) or 1.0
        probe /= largest
    step = 1 / (1.05 * largest)
    uses = ahead = np.zeros(len(rows))
    pace = 1.0
    for _ in range(steps):
        down = np.maximum(ahead - step * pull(square * (lengths_of(ahead) - target)), 0)
        if (ahead - down) @ (down - uses) > 0:  # the momentum leads uphill: start it anew
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = down + (pace - 1) / faster * (down - uses)
        uses, pace = down, faster
    return uses * scale


@dataclass
class Group:
    """`count` sequences with the same parts (length, times), in the order in which they lie there."""
    parts: tuple[tuple[int, int], ...]
    count: int


def _taken(rows: np.ndarray, uses: np.ndarray, counts: np.ndarray) -> list[Group]:
    """Whole uses of the patterns, most used first, as far as the counts last, and off the counts."""
    out = []
    for at in np.argsort(-uses, kind="stable").tolist():
        wanted = int(uses[at])
        if not wanted:
            break
        parts = Counter(x for x in rows[at].tolist() if x)
        count = min(wanted, *(int(counts[x]) // n for x, n in parts.items()))
        if count:
            for x, n in parts.items():
                counts[x] -= count * n
            out.append(Group(tuple(sorted(parts.items(), reverse=True)), count))
    return out


def best_fit(counts: np.ndarray, capacity: int) -> list[Group]:
    """Best fit, longest first, over counts of lengths: alike sequences are filled together."""
    spaces: list[list[Group]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            space = next((s for s in range(length, capacity) if spaces[s]), None)
            if space is None:
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    spaces[capacity - each * length].append(Group(((length, each),), whole))
                if rest:
                    spaces[capacity - rest * length].append(Group(((length, rest),), 1))
                break
            group = spaces[space].pop()
            each = min(space // length, left)
            filled = min(group.count, left // each)
            if filled < group.count:
                spaces[space].append(Group(group.parts, group.count - filled))
            spaces[space - each * length].append(Group((*group.parts, (length, each)), filled))
            left -= each * filled
    return [group for groups in spaces for group in groups]


def fewest(counts: np.ndarray, capacity: int) -> list[Group]:
    """Groups that hold all documents: patterns by the fit, best fit for the residue.

    Solutions are rounded down; then the largest fractions are rounded up while documents last, or not; then what is left
    is fitted again, or packed. Of these ways and weighings the one with the fewest sequences counts, the first of equals.
    """
    best, least = None, None
    for power in POWERS:
        for up in (False, True):
            left, fitted = counts.copy(), []
            for _ in range(ROUNDS):
                rows = patterns(np.flatnonzero(left), capacity)
                found = []
                if len(rows):
                    uses = least_squares(rows, left, power)
                    whole = np.floor(uses + 1e-6)
                    found = _taken(rows, whole, left)
                    if up:
                        order = np.argsort(whole - uses, kind="stable")[:int((uses - whole > 0.02).sum())]
                        found += _taken(rows[order], np.ones(len(order)), left)
                if best is not None and not found:
                    break
                fitted = fitted + found
                groups = fitted + best_fit(left, capacity)
                size = sum(g.count for g in groups)
                if least is None or size < least:
                    best, least = groups, size
    return best


@dataclass
class Plan:
    """Runs of documents of one length, sorted by `keys` = length and number of the first document within its length."""
    keys: np.ndarray
    times: np.ndarray
    sequences: np.ndarray
    places: np.ndarray
    n_sequences: int

    @classmethod
    def of(cls, counts: np.ndarray, capacity: int) -> Plan:
        """A plan for counts indexed by length, 0 to the capacity; it has a place for each document."""
        left = counts.astype(np.int64).copy()
        left[0] = 0
        groups = fewest(left, capacity)
        seen, first, runs = np.zeros(capacity + 1, dtype=np.int64), 0, []
        for group in groups:
            place = 0
            for length, times in group.parts:
                runs.append((length << RANK_BITS | int(seen[length]), times, first, place))
                seen[length] += times * group.count
                place += length * times
            first += group.count
        table = np.array(sorted(runs), dtype=np.int64).reshape(len(runs), 4)
        return cls(*table.T.copy(), first)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and place of the documents with the given numbers (from 0) within their lengths."""
        at = np.searchsorted(self.keys, lengths << RANK_BITS | ranks, "right") - 1
        within = ranks - (self.keys[at] & ((1 << RANK_BITS) - 1))
        return self.sequences[at] + within // self.times[at], self.places[at] + within % self.times[at] * lengths


class _Encoder:
    """Token ids of whole texts in a task, as bytes of unsigned 32-bit numbers; units that no token crosses are remembered.

    Units behind a single space are kept under their letters, all others under a space and the unit. New units of the first
    kind go to the library many in one text: a token that begins with a space begins a unit, as they have no other space.
    """

    def __init__(self, data: bytes, by_unit: bool):
        from tokenizers import Tokenizer as Library

        library = Library.from_str(data.decode())
        library.no_truncation()
        library.no_padding()
        self.by_unit = by_unit
        self.units: dict[str, bytes] = {}
        self.encode = lambda texts: [
            np.array(e.ids, dtype="<u4") for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        vocabulary = library.get_vocab(True)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] == "\u0120"]] = True  # how byte-level files write a space

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if not self.by_unit:
            return [x.tobytes() for x in self.encode(texts)]
        units = self.units
        if len(units) > UNITS_KEPT:
            units.clear()
        units[" "] = b""
        cut, wanted = [], set()
        for text in texts:
            body = text.rstrip()
            head, *rest = body.split(" ")
            new = set(rest).difference(units)
            if any(not k or k[0].isspace() or k[-1].isspace() for k in new):
                # white space stands beside a space, and units are not what single spaces part
                keys = [" " + u for u in space_units(text)]
                new = set(keys).difference(units)
            else:
                keys = [" " + head, *rest, " " + text[len(body):]]
                new.update({keys[0], keys[-1]}.difference(units))
            cut.append(keys)
            wanted |= new
        spaced = [k for k in wanted if k[0] != " "]
        plain = [k for k in wanted if k[0] == " "]
        units.update(zip(plain, (x.tobytes() for x in self.encode([k[1:] for k in plain]))))
        groups = [spaced[i:i + UNITS_JOINED] for i in range(0, len(spaced), UNITS_JOINED)]
        for group, found in zip(groups, self.encode([" " + " ".join(g) for g in groups])):
            starts = np.flatnonzero(self.begins[found])
            if len(starts) != len(group):
                raise ValueError("a unit of the text does not begin with a token that begins with a space")
            ends = [*(4 * starts[1:]).tolist(), 4 * len(found)]
            data = found.tobytes()
            units.update((k, data[a:z]) for k, a, z in zip(group, (4 * starts).tolist(), ends))
        out = [b"".join(map(units.__getitem__, keys)) for keys in cut]
        for key in wanted:
            if len(key) > UNIT_LENGTH_KEPT:
                del units[key]
        return out


def pieces(docs: DataFrame, tokenizer: Tokenizer, capacity: int, end: int, key: str = "doc_id", text: str = "text",
           ids: bool = False) -> DataFrame:
    """One row per piece of a document: the key, piece (from 0), start, length, ids_crc32 and, if asked for, the ids.

    A document is the ids of its whole text and the id `end`; a null text is an empty one. Documents of over `capacity`
    ids are cut so that all pieces but the first are full.
    """
    if tokenizer.kind != "json":
        raise ValueError("token ids are taken from files of the tokenizers library")
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer.data)
    by_unit = tokenizer.by_unit

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if not hasattr(sent, "_encoder"):  # a worker that is used again goes on with what it remembers
            sent._encoder = _Encoder(sent.value, by_unit)
        encoder = sent._encoder
        last = np.array([end], dtype="<u4").tobytes()
        for rows in slices(batches):
            owner, out, tokens = [], [], []
            for at, coded in enumerate(encoder.ids([x or "" for x in rows.column(1).to_pylist()])):
                found = np.frombuffer(coded + last, dtype="<u4")
                start, piece = 0, 0
                while start < len(found):
                    stop = start + ((len(found) - start - 1) % capacity + 1 if not piece else capacity)
                    part = found[start:stop]
                    owner.append(at)
                    out.append((piece, start, stop - start, zlib.crc32(part.tobytes())))
                    if ids:
                        tokens.append(part.astype(np.int32))
                    start, piece = stop, piece + 1
            numbers = np.array(out, dtype=np.int64).reshape(len(out), 4)
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(owner, pa.int64())), pa.array(numbers[:, 0].astype(np.int32)),
                pa.array(numbers[:, 1]), pa.array(numbers[:, 2]), pa.array(numbers[:, 3]),
                *([pa.array(tokens, pa.list_(pa.int32()))] if ids else [])], names)

    added = {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint"} | ({"ids": "array<int>"} if ids else {})
    names = ["_key", *added]
    given = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = given.select("_key", *[F.lit(None).cast(kind).alias(c) for c, kind in added.items()]).schema
    return given.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: Tokenizer, capacity: int = 1024, end: int = 2, key: str = "doc_id", text: str = "text",
         ids: bool = False) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset, their place; `ids` adds the token ids themselves.

    Places of a sequence are gapless from 0 and no sequence holds more than `capacity` ids. Every row of `docs` is packed
    on its own, whatever its key: null and repeated keys stay apart. A null or empty text is the id `end` alone. Other
    columns are left out, an empty table gives no rows.

    Texts are encoded once, and the pieces, narrow rows unless ids are asked for, are written to the shared folder. The
    driver gets the count of each length; tasks get the runs of the plan, whose number is bounded by the patterns.
    """
    if not 0 < capacity < 1 << 14:
        raise ValueError("the patterns of a capacity of 16384 or more are too many to fit")
    cut = freeze(pieces(docs, tokenizer, capacity, end, key, text, ids)).withColumn("_at", F.monotonically_increasing_id())
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in cut.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = count
    plan = Plan.of(counts, capacity)
    keys, times, sequences, places = plan.keys, plan.times, plan.sequences, plan.places
    sent = docs.sparkSession.sparkContext.broadcast((keys, times, sequences, places))
    numbered = number_rows(cut, [F.col("_at")], ["length"], name="_rank")
    columns = ["_key", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Plan(*sent.value, 0)
        for rows in batches:
            found = runs.find(rows.column("length").to_numpy(), rows.column("_rank").to_numpy() - 1)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in columns], *map(pa.array, found)], [*columns, "sequence_id", "offset"])

    rows = numbered.select(*columns, F.col("_rank").cast("long").alias("_rank"))
    zero = F.lit(None).cast("long")
    schema = rows.select(*columns, zero.alias("sequence_id"), zero.alias("offset")).schema
    placed = rows.mapInArrow(place, schema)
    return placed.withColumnRenamed("_key", key)
