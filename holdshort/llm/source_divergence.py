"""How far the vocabularies of two sources of one language lie apart, term by term, in exact whole numbers.

Each (language, source) group is an array of (term number, count), sorted and cut into blocks of term numbers. A pair of
groups is one task per block: their two arrays meet under the unordered pair, the shorter is sought in the longer, and
the terms of both, of one side only and of neither are priced from the two groups' totals. Terms that neither has are
never listed: their number times one difference is what they are worth.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdshort.llm.batches import slices
from holdshort.llm.ordering import in_order
from holdshort.llm.rows import few
from holdshort.llm.units import separated
from holdshort.operators.spread import spread_join
from holdshort.session import freeze

SCALE, PRIOR = 1_000_000_000, 5
#: Term numbers of one block: a pair task holds two arrays of at most so many entries.
BLOCK = 1 << 14
#: Counts a task holds before it hands them on.
HELD = 200_000

#: Bytes of terms, with A-Z lowered; all others part terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> Counter[bytes]:
    """Occurrences of each term in a whole text in UTF-8: runs of letters and of characters outside ASCII."""
    found: Counter[bytes] = Counter()
    for part in separated((text or b"").translate(TERM_BYTES)):
        found.update(part.split())
    return found


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; a row without a term stands for a group."""
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
                        F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def flushed() -> pa.RecordBatch:
            columns = [[], [], [], [], []]
            for (a, b), (n, in_docs) in groups.items():
                size = len(n) + 1
                for column, values in zip(columns, ([a] * size, [b] * size, [None, *n], [0, *n.values()], [0, *map(in_docs.get, n)])):
                    column.extend(values)
            groups.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary()).cast(pa.string()),
                 pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], ["lang", "source", "term", "n", "docs"])

        for rows in slices(batches):
            texts = rows.column(2).cast(pa.binary()).to_pylist()
            for a, b, value in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts):
                n, in_docs = groups[a, b]
                found = terms_of(value)
                n.update(found)
                in_docs.update(found.keys())
            if sum(len(n) for n, _ in groups.values()) > HELD:
                yield flushed()
        if groups:
            yield flushed()

    counted = given.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), in decimals."""
    wide = [x.cast("decimal(20,0)") for x in (count + PRIOR, F.greatest(total + PRIOR * kept, F.lit(1).cast("long")))]
    return F.lit(1).cast("long") + F.call_function("div", wide[0] * F.lit(SCALE).cast("decimal(10,0)"), wide[1])


def prices(counts: np.ndarray, divisor: int) -> np.ndarray:
    """The same in numpy: the quotient grows by three digits at a time, so nothing exceeds 64 bits."""
    if divisor >= 1 << 53:
        return np.array([1 + SCALE * (int(c) + PRIOR) // divisor for c in counts], dtype=np.int64)
    quotient, rest = np.divmod(counts + PRIOR, divisor)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, divisor)
        quotient = quotient * 1000 + more
    return quotient + 1


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a sorted array stand in a longer sorted one: steps double until they pass the value, then
    the last step is halved; all values step at once."""
    if not len(short) or not len(long):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    # each value starts where an even spread would put it
    last = len(long) - 1
    low = np.arange(len(short)) * len(long) // len(short)
    high, step = low.copy(), 1
    while True:
        down, up = (low > 0) & (long[low] > short), (high < last) & (long[high] < short)
        if not (down | up).any():
            break
        low, high = np.where(down, np.maximum(low - step, 0), low), np.where(up, np.minimum(high + step, last), high)
        step *= 2
    while (wide := low < high).any():
        middle = (low + high) // 2
        below = long[middle] < short
        low, high = np.where(wide & below, middle + 1, low), np.where(wide & ~below, middle, high)
    hit = long[low] == short
    return np.flatnonzero(hit), low[hit]


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], divisors: tuple[int, int]) -> tuple[int, int]:
    """Sum of |p - q| over the terms that at least one of two sparse arrays (numbers, counts) lists, and their number."""
    swapped = len(a[0]) > len(b[0])
    short, long = (b, a) if swapped else (a, b)
    of_short, of_long = divisors[::-1] if swapped else divisors
    p, q = prices(short[1], of_short), prices(long[1], of_long)
    at, where = gallop(short[0], long[0])
    absent = [int(prices(np.zeros(1, dtype=np.int64), d)[0]) for d in (of_short, of_long)]
    one, other = np.abs(p - absent[1]), np.abs(q - absent[0])
    value = int(np.abs(p[at] - q[where]).sum()) + int(one.sum() - one[at].sum()) + int(other.sum() - other[where].sum())
    return value, len(p) + len(q) - len(at)


def _pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for each unordered pair of the groups of a language; groups have `total` and `kept`."""
    sides = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "kept")
    others = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = freeze(sides.join(others, "lang").where("a < b"))
    arrays = freeze(cells.groupBy("lang", "source", F.floor(F.col("term_id") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("term_id", "n"))).alias("_cells")).select(
        "lang", "source", "block", F.col("_cells.term_id").alias("ids"), F.col("_cells.n").alias("counts")))

    def side(name: str) -> DataFrame:
        own = arrays.select("lang", F.col("source").alias(name), "block", F.col("ids").alias(f"ids_{name}"),
                            F.col("counts").alias(f"counts_{name}"))
        return own.join(pairs.select("lang", "a", "b", "total_a", "total_b", "kept"), ["lang", name])

    keys = ["lang", "a", "b", "total_a", "total_b", "kept", "block"]
    met = side("a").join(side("b"), keys, "full")

    def price_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=np.int64)
        for rows in slices(batches, 64):
            values, listed = [], []
            columns = [rows.column(c) for c in ("ids_a", "counts_a", "ids_b", "counts_b")]
            totals = zip(*[rows.column(c).to_pylist() for c in ("total_a", "total_b", "kept")])
            for at, (total_a, total_b, kept) in enumerate(totals):
                ids_a, n_a, ids_b, n_b = (c[at].values.to_numpy() if c[at].is_valid else none for c in columns)
                value, n = merged((ids_a, n_a), (ids_b, n_b), (total_a + PRIOR * kept, total_b + PRIOR * kept))
                values.append(value)
                listed.append(n)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("lang", "a", "b")], pa.array(values, pa.int64()), pa.array(listed, pa.int64())],
                ["lang", "a", "b", "value", "listed"])

    parts = met.mapInArrow(price_pairs, "lang string, a string, b string, value bigint, listed bigint")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("_value"), F.sum("listed").alias("_listed"))
    nothing = F.lit(0).cast("long")
    absent = F.abs(price(nothing, F.col("total_a"), F.col("kept")) - price(nothing, F.col("total_b"), F.col("kept")))
    rest = (F.col("kept") - F.coalesce("_listed", nothing)) * absent
    return pairs.join(summed, ["lang", "a", "b"], "left").select(
        "lang", "a", "b", F.when(F.col("kept") > 0, F.coalesce("_value", nothing) + rest).otherwise(nothing).alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30,
          top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: what sets a source apart from the others and from its language.

    Part `pair` has each other source of the language, with the sum of |p - q| over all kept terms; part `term` the terms
    that the source has more of than its language, with p - q, up to rank `top`. Kept are the terms in at least
    `min_docs` documents of the language; p is 1 + floor(10^9 (count + 5) / (total + 5 kept)). Ranks go by value
    descending, then item in UTF-8.

    Null text, lang and source are read as ''. Groups without terms take part with counts of 0; in a language without
    kept terms all values are 0. Repeated rows count each time, other columns are left out, an empty table gives no rows.
    Sources of a language are paired because the pairs are the result; term arrays are in blocks of bounded size, and of
    one group's terms each task hands on its first `top` alone.
    """
    counts = freeze(term_counts(docs, lang, source, text))
    groups = freeze(counts.where("term IS NULL").select("lang", "source"))
    by_lang = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    kept = in_order(by_lang, [F.col("lang"), F.col("term")], position="term_id")
    cells = freeze(spread_join(counts.where("term IS NOT NULL").drop("docs"), kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    totals = freeze(groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "kept")]))

    pairs = freeze(_pair_values(cells.select("lang", "source", "term_id", "n"), totals.select("lang", "source", "total", "kept")))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    priced = cells.join(few(totals), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        price(F.col("n"), F.col("total"), F.col("kept")).alias("_p"),
        price(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("_q"))
    more = priced.where("_p > _q").select("lang", "source", "item", (F.col("_p") - F.col("_q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked_pairs = both.withColumn("rank", rank).withColumn("part", F.lit("pair"))
    ranked_terms = more.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return ranked_pairs.unionByName(ranked_terms).select("lang", "source", "part", "item", "value", "rank")
