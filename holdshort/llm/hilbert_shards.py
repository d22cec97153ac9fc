"""Shards cut as runs of a Hilbert curve through several metadata columns.

Each metadata column is quantised to the same number of steps, the steps are the coordinates of a point, and rows are
sorted by the index of the point on a Hilbert curve. Neighbours on the curve are neighbours in every dimension, so a
shard, and each file or row group within it, covers a small box of the metadata space and a filter on any of the columns
can skip the others. Runs of the order are cut so that row counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.llm.ordering import in_order

#: Bytes of a string that are compared after the prefix that all values share.
STRING_BYTES = 6


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of coordinates in 0 … 2^bits - 1; dimensions x bits must be below 64."""
    x = points.astype(np.uint64).T.copy()
    one, dims = np.uint64(1), len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns of ever smaller cells
        bit = one << np.uint64(level)
        low = bit - one
        for i in range(dims):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[dims - 1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(level)) & one)
    return out.astype(np.int64)


def _number(value: Column, skip: int) -> Column:
    """The bytes of a string after the first `skip` as a whole number, in the order of the strings."""
    part = F.substring(F.encode(value, "UTF-8"), skip + 1, STRING_BYTES)
    return F.conv(F.rpad(F.hex(part), 2 * STRING_BYTES, "0"), 16, 10).cast("double")


def quantised(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Steps 1 … 2^bits - 1 of each column between its least and largest value, in the columns' order; null is step 0.

    Strings are compared by the bytes after their common prefix. Two values per column reach the driver.
    """
    kinds = dict(df.dtypes)
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("low", F.min), ("high", F.max))]).first()
    steps = (1 << bits) - 1
    out = []
    for i, column in enumerate(columns):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        if low is None:
            out.append(F.lit(0))
            continue
        if kinds[column] == "string":
            first, last = low.encode(), high.encode()
            skip = next((k for k, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
            number, span = _number(F.col(column), skip), [
                int.from_bytes(x[skip:skip + STRING_BYTES].ljust(STRING_BYTES, b"\0"), "big") for x in (first, last)]
        else:
            number, span = F.col(column).cast("double"), [float(low), float(high)]
        share = (number - F.lit(float(span[0]))) / F.lit(float(span[1]) - float(span[0]) or 1.0)
        out.append(F.coalesce(1 + F.least(F.floor(share * steps), F.lit(steps - 1)), F.lit(0)).cast("int"))
    return out


def curve_index(steps: Sequence[Column], bits: int) -> Column:
    """Index on the curve of the point with these coordinates."""
    @F.pandas_udf("bigint")
    def index(points: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(points.to_numpy()), bits) if len(points) else [], dtype="int64")

    return index(F.array(*steps))


def shards(df: DataFrame, columns: Sequence[str], tie: Sequence[str], n_shards: int = 8, bits: int = 10) -> DataFrame:
    """Add curve_index, shard (0 … n_shards - 1) and slot (from 0, without gaps in each shard).

    `columns` are the metadata dimensions; rows with one index are ordered by `tie`, then by all other columns, so the
    result is the same in every run; only alike rows could change places. Row counts of shards differ by one at most; with
    fewer rows than shards some stay empty. Pass narrow rows: all columns are sorted along. Columns named like the added
    ones are an error.
    """
    clash = {"curve_index", "shard", "slot"} & set(df.columns)
    if clash:
        raise ValueError(f"the input already has {sorted(clash)}")
    indexed = df.withColumn("curve_index", curve_index(quantised(df, columns, bits), bits))
    rest = [c for c in df.columns if c not in tie]
    ordered = in_order(indexed, [F.col(c).asc_nulls_last() for c in ("curve_index", *tie, *rest)])
    n = F.lit(ordered.count())
    shard = F.floor(F.col("_position") * n_shards / n)
    first = F.ceil(shard * n / n_shards)
    return ordered.withColumns({"shard": shard.cast("int"), "slot": (F.col("_position") - first).cast("long")}).drop("_position")
