"""Mix sources to target sizes: whole epochs first, then a weighted sample without replacement up to the word.

Targets: the sources share a total by weight; a source takes at most `most` times its size, and what it cannot take is
shared by the others by weight. That is one water level: a source gets level x weight or its cap, whichever is less. With
sources in the order of cap / weight the level follows from running sums.

Sampling (Efraimidis and Spirakis): each document gets an exponential key, divided by its quality weight, from a hash of
its id; documents are sorted by source and key, and running sums of words tell which of them fit into the source's budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.llm.ordering import in_order
from holdshort.session import freeze

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>!"
SEED = 17
#: Sources are sent to all tasks up to this number and joined by shuffle beyond it.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for a text without symbols, less the more symbols stand on its words."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * symbols.cast("double") / F.greatest(size, F.lit(1)).cast("double"))


def exponential_key(key: Column, weight: Column, seed: int = SEED) -> Column:
    """-ln(u) / weight, u in (0, 1) from 52 bits of a hash of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    share = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.log(share) / weight


def source_targets(rows: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """source, source_size, words_before (of sources that come earlier), target; `rows` has source and size."""
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    named = in_order(sizes, [F.col("source").asc_nulls_last()], {"words_before": "source_size"})
    turn = (F.col("_position") % len(weights) + 1).cast("int")
    weighed = freeze(named.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn).cast("long"))
                     .withColumn("cap", most * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
                     .drop("_position"))
    words, heft = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    levels = in_order(weighed.select("source", "weight", "cap", "fill"), [F.col("fill"), F.col("source").asc_nulls_last()],
                      {"_caps": "cap", "_weights": "weight"})
    level = (F.lit(share * (words or 0)) - F.col("_caps")) / (F.lit(heft or 0) - F.col("_weights"))
    found = levels.where(level < F.col("fill")).agg(F.min_by(level, "_position")).first()[0]
    target = F.col("cap").cast("double")
    if found is not None:
        target = F.least(target, F.lit(found) * F.col("weight"))
    return weighed.select("source", "source_size", "words_before", target.alias("target"))


def mix(rows: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2,
        carry: Sequence[str] = ()) -> DataFrame:
    """How many words of each document go into the mix.

    `rows` is narrow: key, source, size (words; at least 0) and weight (above 0), and the columns named in `carry`.
    Returns key, source, size, carried columns, source_size, target and taken: as many whole epochs as fit, and for the
    rest of the budget the documents with the smallest exponential keys; the last of them is cut at the word, so that a
    source's taken words differ from its target by rounding only. No document is taken more than `most` times. Sources
    weigh `weights` in turn, by code point, null last. Repeated rows are drawn one by one; rows with one key have one
    exponential key, and of alike rows any may be the one that is cut. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    narrow = freeze(rows.select("key", "source", "size", exponential_key(F.col("key"), F.col("weight")).alias("draw"), *carry))
    targets = freeze(source_targets(narrow, weights, share, most).select(
        F.col("source").alias("_source"), "source_size", F.col("words_before").alias("_start"), "target"))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    order = [F.col("source").asc_nulls_last(), F.col("draw"), F.col("key").asc_nulls_last(), F.col("size"), *map(F.col, carry)]
    placed = in_order(narrow, order, {"_words": "size"}).join(targets, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size") - (F.col("_words") - F.col("_start"))
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select("key", "source", "size", *carry, "source_size", "target", taken.cast("long").alias("taken"))
