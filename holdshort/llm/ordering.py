"""Exact positions and running sums over a total order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdshort.session import freeze

IN_PIECE = (1 << 33) - 1


def in_order(df: DataFrame, order: Sequence[Column], sums: dict[str, str] | None = None, position: str = "_position") -> DataFrame:
    """Add the 0-based position in the order, and for each entry `name: column` the sum of the rows before.

    The order must be total for the result to be defined; rows that tie in it must be alike. Rows are range-partitioned
    and sorted, and the sorted pieces are frozen in the shared folder, because a second run may cut them elsewhere. Each
    row is numbered within its piece, and one row per piece tells how much comes before it: that table has as many rows
    as there are partitions, whatever the input. Null values count as 0 in sums.
    """
    sums = sums or {}
    ordered = freeze(df.orderBy(*order)).withColumn("_mark", F.monotonically_increasing_id())
    pieces = ordered.withColumns({"_piece": F.shiftright("_mark", 33), "_row": F.col("_mark").bitwiseAND(IN_PIECE)})
    totals = pieces.groupBy("_piece").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).cast("long").alias(f"_sum_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums])
    joined = pieces.join(F.broadcast(before), "_piece")
    if sums:
        within = Window.partitionBy("_piece").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        joined = joined.withColumns({
            n: (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_before_{n}")).cast("long") for n, c in sums.items()})
    return joined.withColumn(position, F.col("_rows_before") + F.col("_row")).select(*df.columns, position, *sums)
