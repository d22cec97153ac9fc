"""Joins and ordered scans that keep their balance when one key holds a large part of the rows.

Two ideas are used throughout the library:

* a table is collapsed to one row per (key, instant) with a partial aggregate before it is ordered, and the
  ordered window runs per (key, time slot); what a slot needs from earlier slots is carried in as one row;
* a join of a wide table with a one-row-per-key table is planned so that an oversized key can be split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdshort.functions.timing import slot
from holdshort.session import freeze

SPLITS = 32
SLOT_S = 3600
#: Rows of a piece of a table that fits read many times: some 200 MB as a tree's bins.
PIECE_ROWS = 500_000


def spread_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join (inner, left, left_semi, left_anti) of a table with one that is unique, or nearly so, per key.

    The small side usually comes out of an aggregate on the same keys. Spark would reuse that shuffle, and adaptive
    execution splits an oversized key only where both join sides are shuffled for the join itself. A redundant join
    column, a hash of the keys, makes it so. Without adaptive skew handling the rows of a key are dealt to SPLITS tasks
    and the small side is repeated for each; the deal depends only on the row and the number of its input partition, so
    a re-run task deals alike.
    """
    conf = big.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true" and conf.get("spark.sql.adaptive.skewJoin.enabled") == "true":
        mark = F.xxhash64(*[F.col(c) for c in on])
        return big.withColumn("_spread", mark).join(small.withColumn("_spread", mark), [*on, "_spread"], how).drop("_spread")
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]) + F.spark_partition_id(), F.lit(SPLITS))
    dealt = big.withColumn("_split", deal.cast("int"))
    repeated = small.withColumn("_split", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))))
    return dealt.join(repeated, [*on, "_split"], how).drop("_split")


def even_pieces(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Deal rows evenly, in pieces of at most about `piece_rows`, and at least one for each core.

    The pieces of a scan follow the files: one small file is one task, and a large one's pieces grow when its columns are
    widened to vectors.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / piece_rows))
    return rows.repartition(parts)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join in which null keys match each other."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, same).drop(*[f"_right_{c}" for c in on])


def one_per_instant(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Keep one row per (keys, ts), the one with the smallest remaining columns (in column order)."""
    rest = [c for c in df.columns if c not in keys and c != ts]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys, ts).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) if c in rest else F.col(c) for c in df.columns])


def _neighbour(df, keys, columns, names, ts, slot_s, forward):
    edge, step = (F.min, -1) if forward else (F.max, 1)
    row = F.struct(F.col(ts), *[F.col(c) for c in columns if c != ts])
    slotted = df.withColumn("_slot", slot(ts, slot_s))
    edges = slotted.groupBy(*keys, "_slot").agg(edge(row).alias("_edge"))
    over_slots = Window.partitionBy(*keys).orderBy("_slot")
    carry = edges.select(*keys, "_slot", F.lag("_edge", step).over(over_slots).alias("_carry"))
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(ts)
    near = F.coalesce(F.lag(row, step).over(in_slot), F.col("_carry"))
    out = slotted.join(carry, [*keys, "_slot"], "left").withColumn("_near", near)
    out = out.withColumns({n: F.col("_near")[c] for c, n in zip(columns, names)})
    return out.select(*df.columns, *names)


def previous_in_time(df: DataFrame, keys: Sequence[str], columns: Sequence[str], names: Sequence[str],
                     ts: str = "ts", slot_s: int = SLOT_S) -> DataFrame:
    """Add columns of the preceding row of the same keys. `df` has one row per (keys, ts)."""
    return _neighbour(df, keys, columns, names, ts, slot_s, forward=False)


def next_in_time(df: DataFrame, keys: Sequence[str], columns: Sequence[str], names: Sequence[str],
                 ts: str = "ts", slot_s: int = SLOT_S) -> DataFrame:
    """Add columns of the following row of the same keys. `df` has one row per (keys, ts)."""
    return _neighbour(df, keys, columns, names, ts, slot_s, forward=True)


def last_event_before(points: DataFrame, events: DataFrame, keys: Sequence[str], payload: Sequence[str],
                      ts: str = "ts", slot_s: int = SLOT_S) -> DataFrame:
    """For each distinct (keys, ts) of `points`, the last event strictly before it.

    `events` has one row per (keys, ts). Returns keys, ts and a struct column `event` (ts, payload…), null if there
    is no earlier event. Points and events are merged per slot; earlier slots send in their last event.
    """
    event_row = F.struct(F.col(ts).alias(ts), *[F.col(c) for c in payload])
    ev = events.select(*keys, ts, F.lit(1).alias("_kind"), event_row.alias("_event"))
    pt = points.select(*keys, ts).distinct().select(
        *keys, ts, F.lit(0).alias("_kind"), F.lit(None).cast(ev.schema["_event"].dataType).alias("_event"))
    merged = pt.unionByName(ev).withColumn("_slot", slot(ts, slot_s))
    over_slots = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        merged.groupBy(*keys, "_slot").agg(F.max("_event").alias("_tail"))
        .select(*keys, "_slot", F.last("_tail", ignorenulls=True).over(over_slots).alias("_carry"))
    )
    # at one instant the point sorts before the event, which makes the comparison strict
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(ts, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = merged.join(carry, [*keys, "_slot"]).withColumn(
        "event", F.coalesce(F.last("_event", ignorenulls=True).over(in_slot), F.col("_carry")))
    return found.where(F.col("_kind") == 0).select(*keys, ts, "event")


def number_rows(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = (), name: str = "seq",
                parts: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact 1-based row numbers per key in the given order, however many rows a key has.

    With `weight`, a column of counts, a row stands for so many rows and gets the number of the last of them.

    Rows are range-partitioned by (keys, order), so a long key spans many pieces of equal size; the pieces are frozen
    because their limits come from a sample, then numbered one by one and shifted by the sizes of earlier pieces.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = freeze(df.repartitionByRange(parts, *keys, *order).withColumn("_piece", F.spark_partition_id()))
    sizes = pieces.groupBy(*keys, "_piece").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "_piece").orderBy(*order)
    joined = null_safe_join(pieces, shifts, [*keys, "_piece"])
    place = F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0)) if weight else F.row_number().over(within)
    return joined.withColumn(name, place + F.col("_before")).drop("_piece", "_before")


def with_halo(numbered: DataFrame, before: int, seq: str = "seq", block_rows: int = 100_000) -> DataFrame:
    """Cut numbered rows into blocks; each block also gets the `before` rows ahead of it, from as many blocks as they span.

    Adds `block` and `own` (false for borrowed rows).
    """
    at = F.col(seq) - 1
    home = F.floor(at / F.lit(block_rows)).cast("long")
    last = F.floor((at + before) / F.lit(block_rows)).cast("long")
    return numbered.withColumn("block", F.explode(F.sequence(home, last))).withColumn("own", F.col("block") == home)
