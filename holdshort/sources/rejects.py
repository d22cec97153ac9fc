"""Rejected rows: kept with a reason and counted in the pass that writes the accepted ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdshort.session import scratch_path

LINE, REASON = "_line", "_reason"


@dataclass
class Checked:
    """Accepted rows without the marks, rejected ones as (line, reason), and the numbers of both."""

    accepted: DataFrame
    rejected: DataFrame
    read: int
    n_rejected: int


def split_rejects(marked: DataFrame, path: str | None = None) -> Checked:
    """Write rows marked with `_line` and `_reason` (null: accepted) once, below `path` or in the shared folder.

    Both numbers are observed while the rows are written. Every row is in one of the two tables; an empty table gives two.
    """
    spark = marked.sparkSession
    path = path or scratch_path(spark, "checked")
    seen = Observation("read")
    watched = marked.observe(seen, F.count(F.lit(1)).alias("read"), F.count(REASON).alias("rejected"))
    watched.withColumn("_accepted", F.col(REASON).isNull()).write.partitionBy("_accepted").parquet(path)
    numbers = seen.get
    stored = spark.read.schema(T.StructType([*marked.schema.fields, T.StructField("_accepted", T.BooleanType())])).parquet(path)
    return Checked(stored.where("_accepted").drop("_accepted", LINE, REASON),
                   stored.where("NOT _accepted").select(F.col(LINE).alias("line"), F.col(REASON).alias("reason")),
                   numbers["read"], numbers["rejected"])
