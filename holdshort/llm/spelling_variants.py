"""Group words with their spelling variants: words one insertion, deletion or replacement apart, found by FM-index.

Two words at distance one agree in the first or in the second half of either of them. One search reads a word from left
to right: its first half must match, the rest may have one error; the other reads it from right to left. Each direction
has its index: the last-column transform of the delimited words, in which every step is an interval of suffix ranks, in
text order for one direction and reversed for the other. A search with two parts and one error never turns round, so the
two indexes need no common intervals.

The vocabulary may be of any size: words are sorted (for the second search, by their reversal), cut into shards of bounded
length, and one index is built per shard inside a task. A word visits the shards in which its exact half begins some word
of a fitting length; these come from an equi-join on the half, and the words of such a shard stand next to each other in the
order.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.llm.batches import slices
from holdshort.llm.ordering import in_order
from holdshort.llm.units import separated
from holdshort.operators.spread import spread_join
from holdshort.session import freeze

#: Characters of one shard, with a delimiter per word; a longer word is a shard of its own.
SHARD_CHARS = 1 << 17
#: Bytes of a rank table; larger shards keep only some of its rows and count the rest.
TABLE_BYTES = 64 << 20
#: Words a task searches at once, and counts it holds before it hands them on.
SEARCHED, HELD = 4096, 200_000
DELIMITER = 1

#: Latin-1 letters with A-Z lowered; all others part words. Characters outside Latin-1 are encoded as question marks.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))


def words_of(text: str | None, key: str, noise: int = 31) -> Counter[bytes]:
    """Words of a whole text in Latin-1; where `noise` divides the digest of key and word, one of its letters goes."""
    start = zlib.crc32(f"{key}:".encode())
    out: Counter[bytes] = Counter()
    runs: Counter[bytes] = Counter()
    for part in separated((text or "").encode("latin-1", "replace").translate(LETTERS)):
        runs.update(part.split())
    for run, n in runs.items():
        digest = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if noise and digest % noise == 0:
            at = digest % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2,
               noise: int = 31) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences over all documents; null keys and texts are empty."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            words, n = [w.decode("latin-1") for w in held], list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        for rows in slices(batches):
            for name, value in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                for word, n in words_of(value, name, noise).items():
                    if len(word) >= min_length:
                        held[word] += n
            if len(held) > HELD:
                yield flushed()
        if held:
            yield flushed()

    given = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.col(text).alias("_text"))
    counted = given.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """Places of the suffixes in their order, by doubling; the last code is smaller than all others. Codes have 7 bits."""
    n, known = len(codes), 8
    padded = np.concatenate([codes.astype(np.int64), np.zeros(known, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(known):
        key = key << 7 | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, dtype=np.int64)
        behind[:max(n - known, 0)] = rank[known:] + 1
        key = rank * (n + 1) + behind
        known *= 2


class Index:
    """FM-index of distinct words that are read from left to right: that of the reversed, delimited text."""

    def __init__(self, words: list[bytes], table_bytes: int = TABLE_BYTES):
        text = np.frombuffer((b"\n" + b"\n".join(words) + b"\n")[::-1], dtype=np.uint8)
        present = np.unique(text)  # the delimiter comes first
        self.code = np.full(256, -1, dtype=np.int64)
        self.code[present] = np.arange(len(present)) + DELIMITER
        codes = np.append(self.code[text], 0)
        self.places = suffix_ranks(codes)
        last = codes[self.places - 1]
        n, symbols = len(codes), len(present) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=symbols))])
        self.every = 1
        while (n // self.every + 1) * symbols * 4 > table_bytes:
            self.every *= 2
        self.last = np.append(last, np.zeros(self.every, dtype=np.int64))
        kept = np.arange(0, n + 1, self.every)
        self.table = np.empty((len(kept), symbols), dtype=np.int32)
        for symbol in range(symbols):
            self.table[:, symbol] = np.concatenate([[0], np.cumsum(last == symbol)])[kept]
        self.starts = np.flatnonzero(codes[::-1][1:] == DELIMITER)

    def ranks(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the last column before a place."""
        row = at // self.every
        out = self.table[row, symbols].astype(np.int64)
        for step in range(self.every - 1):
            place = row * self.every + step
            out += (place < at) & (self.last[place] == symbols)
        return out

    def all_ranks(self, at: np.ndarray) -> np.ndarray:
        row = at // self.every
        out = self.table[row]
        for step in range(self.every - 1):
            place = row * self.every + step
            inside = np.flatnonzero(place < at)
            out[inside, self.last[place[inside]]] += 1
        return out

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches that go on with a symbol; a symbol that no word has (-1) gives an empty one."""
        known = np.maximum(symbols, 0)
        first = self.first[known]
        none = np.where(symbols < 0, 0, 1)
        return (first + self.ranks(known, low)) * none, (first + self.ranks(known, high)) * none

    def word_at(self, rank: np.ndarray) -> np.ndarray:
        """Number of the word whose end delimiter the match with this rank ends in."""
        end = len(self.places) - 2 - self.places[rank]
        return np.searchsorted(self.starts, end) - 1

    def near(self, words: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, found) numbers of all words one error away, the first `exact` letters being equal; each pair once."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = self.code[np.frombuffer(b"\n".join(words) + b"\n", dtype=np.uint8)]
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        query = np.arange(len(words))
        low, high = np.full(len(words), self.first[DELIMITER]), np.full(len(words), self.first[DELIMITER + 1])
        for step in range(int(exact.max(initial=0))):
            on = np.flatnonzero((step < exact) & (low < high))
            low[on], high[on] = self.extend(flat[begin[on] + step], low[on], high[on])
        live = low < high
        same = query[live], exact[live], low[live], high[live]
        wrong = tuple(np.empty(0, dtype=np.int64) for _ in range(4))
        pairs = []
        while len(same[0]) or len(wrong[0]):
            # one letter more on the found side, one replaced, one left out
            q, at, low, high = same
            branch, symbol = np.nonzero(self.all_ranks(high) > self.all_ranks(low))
            letter = symbol > DELIMITER
            branch, symbol = branch[letter], symbol[letter]
            b_low, b_high = self.extend(symbol, low[branch], high[branch])
            b_q, b_at = q[branch], at[branch]
            other = (b_at < sizes[b_q]) & (symbol != flat[begin[b_q] + b_at])
            inside = np.flatnonzero(at < sizes[q])
            # what has its error goes on without one; behind the last letter stands the delimiter
            w_q, w_at, w_low, w_high = wrong
            next_symbol = flat[begin[w_q] + w_at]
            w_low, w_high = self.extend(next_symbol, w_low, w_high)
            ended = (w_at == sizes[w_q]) & (w_low < w_high)
            pairs.append(w_q[ended] * (len(self.starts) + 1) + self.word_at(w_low[ended]))
            on = (w_at < sizes[w_q]) & (w_low < w_high)
            wrong = tuple(np.concatenate(x) for x in (
                (w_q[on], b_q, b_q[other], q[inside]), (w_at[on] + 1, b_at, b_at[other] + 1, at[inside] + 1),
                (w_low[on], b_low, b_low[other], low[inside]), (w_high[on], b_high, b_high[other], high[inside])))
            s_low, s_high = self.extend(flat[begin[q[inside]] + at[inside]], low[inside], high[inside])
            live = s_low < s_high
            same = q[inside][live], at[inside][live] + 1, s_low[live], s_high[live]
        found = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, dtype=np.int64)
        return found // (len(self.starts) + 1), found % (len(self.starts) + 1)


def _best(queries: list[bytes], index: Index, shard: list[bytes], counts: np.ndarray, order: np.ndarray,
          backward: bool) -> tuple[np.ndarray, ...]:
    """Queries with near words in a shard: their number, and number and count of the best of these."""
    sizes = np.fromiter(map(len, queries), dtype=np.int64, count=len(queries))
    q, found = index.near(queries, sizes - sizes // 2 if backward else sizes // 2)
    if backward:  # the other search has those that share the first half
        heads = [w[len(w) - len(w) // 2:] for w in queries]
        new = np.fromiter((not shard[f].endswith(heads[i]) for i, f in zip(q.tolist(), found.tolist())), dtype=bool, count=len(q))
        q, found = q[new], found[new]
    ranked = np.lexsort((order[found], -counts[found], q))
    q, found = q[ranked], found[ranked]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, dtype=np.int64)
    return q[first], np.diff(np.append(first, len(q))), found[first], counts[found[first]]


def _searched(words: DataFrame, backward: bool, min_length: int) -> DataFrame:
    """(word, n_near, best_n, best) per word and shard with near words, for one of the two searches."""
    def half(size: Column) -> Column:
        least = F.floor(size / 2).cast("int")
        return size - least if backward else least

    text = F.reverse("word") if backward else F.col("word")
    read = words.select(text.alias("read"), "n", (F.length("word") + 1).alias("chars"))
    placed = in_order(read, [F.col("read")], sums={"before": "chars"})
    sharded = freeze(placed.select("read", "n", F.floor(F.col("before") / SHARD_CHARS).alias("shard")))
    size = F.length("read")
    # the exact halves of words one letter shorter, as long, and one letter longer
    halves = F.array_distinct(F.array(*[half(size + more) for more in (-1, 0, 1)]))
    keys = sharded.select("shard", "read", F.explode(halves).alias("_half")).where(
        F.col("_half") >= half(F.lit(min_length))).select(
        F.substring("read", F.lit(1), F.col("_half")).alias("head"), "shard").distinct()
    asked = spread_join(sharded.select("read", F.substring("read", F.lit(1), half(size)).alias("head")), keys, ["head"])
    rows = sharded.select("shard", F.lit(0).alias("asked"), "read", "n").unionByName(
        asked.select("shard", F.lit(1).alias("asked"), "read", F.lit(0).cast("long").alias("n")))
    shards = (sharded.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = rows.repartition(int(shards), "shard").sortWithinPartitions("shard", "asked", "read")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index, shard, counts, order = None, None, [], [], None

        def answers(queries: list[bytes]) -> pa.RecordBatch:
            q, n_near, found, best_n = _best(queries, index, shard, counts_of, order, backward)
            turn = slice(None, None, -1 if backward else 1)
            return pa.RecordBatch.from_arrays([
                pa.array([queries[i].decode("latin-1")[turn] for i in q.tolist()], pa.string()), pa.array(n_near, pa.int64()),
                pa.array(best_n, pa.int64()), pa.array([shard[i].decode("latin-1")[turn] for i in found.tolist()], pa.string()),
            ], ["word", "n_near", "best_n", "best"])

        counts_of = None
        for batch in batches:
            for whole in slices(iter([batch]), SEARCHED):
                at = 0
                numbers, kinds = whole.column(0).to_numpy(), whole.column(1).to_numpy()
                read = [w.encode("latin-1") for w in whole.column(2).to_pylist()]
                while at < len(read):
                    stop = at + int(np.argmax(np.append((numbers[at:] != numbers[at]) | (kinds[at:] != kinds[at]), True)))
                    if numbers[at] != current:
                        current, index, shard, counts = numbers[at], None, [], []
                    if kinds[at] == 0:
                        shard.extend(read[at:stop])
                        counts.extend(whole.column(3)[at:stop].to_pylist())
                    else:
                        if index is None:
                            index, counts_of = Index(shard), np.array(counts, dtype=np.int64)
                            order = np.argsort(np.array(sorted(range(len(shard)), key=lambda i: shard[i][::-1]))) if backward \
                                else np.arange(len(shard))
                        yield answers(read[at:stop])
                    at = stop

    return dealt.mapInArrow(search, "word string, n_near bigint, best_n bigint, best string")


def group(words: DataFrame, ratio: int = 10, min_length: int = 7) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words (word, n) of Latin letters.

    A word's form is its near word of largest n (of equal ones the smallest in code-point order), if that is at least
    `ratio` times the word's own; root follows the forms to the last. Words without near words have n_near 0 and no form.
    A null word is left out; words that repeat must be summed before. An empty table gives no rows. Words need at least
    six letters, so that a half tells something.
    """
    words = freeze(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")))
    found = _searched(words, False, min_length).unionByName(_searched(words, True, min_length))
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("_less"), "best")).alias("_best"))
    near = F.coalesce("n_near", F.lit(0).cast("long"))
    is_form = F.coalesce(-F.col("_best._less") >= ratio * F.col("n"), F.lit(False))
    formed = freeze(words.join(best, "word", "left").select(
        "word", "n", near.alias("n_near"), F.when(is_form, F.col("_best.best")).alias("form"),
        F.when(is_form, -F.col("_best._less")).alias("form_n")))
    # each round doubles the way that a word has gone; a step multiplies n, so few are needed
    ways = freeze(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = freeze(spread_join(ways, on, ["root"], "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        moved = longer.where("_moved").limit(1).count()
        ways = longer.drop("_moved")
        if not moved:
            break
    return formed.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
