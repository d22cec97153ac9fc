"""Rows that can be told apart, however alike they are, and joins with a few of them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.llm.ordering import in_order
from holdshort.session import freeze, scratch_path

#: Rows of numbers that are sent to every task at most (16 MB or so); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def few(rows: DataFrame) -> DataFrame:
    """A narrow table for the small side of a join: marked for broadcast if it has few rows, which is counted first."""
    kept = freeze(rows)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """The table with a column of unique numbers, with gaps, that stay the same whenever it is read again.

    Rows of files are numbered by file and place in it. Numbers made anew for each scan could change with the number of
    executors, so a table that is not read straight from files is written to the shared folder first.
    """
    if name in df.columns:
        raise ValueError(f"the input already has a column {name}")
    file, place = f"{name}_file", f"{name}_place"
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        path = scratch_path(df.sparkSession, "rows")
        df.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
        return df.sparkSession.read.parquet(path)
    files = few(in_order(placed.select(file).distinct(), [F.col(file)]))
    number = F.shiftleft(F.col("_position"), 40) + F.col(place)
    return placed.join(files, file).select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))
