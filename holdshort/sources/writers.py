"""Writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.session import freeze


def partition_by_day_hour(rows: DataFrame, path: str, ts: str = "ts", file_rows: int = 5_000_000) -> None:
    """Append to date/hour directories; rows without a time are left out.

    Rows are put in time order in pieces of equal size: a busy hour is shared by several tasks, quiet hours share one,
    and there are at most as many files as hours and tasks together.
    """
    dated = rows.where(F.col(f"`{ts}`").isNotNull()).withColumns({
        "date": F.date_format(F.col(f"`{ts}`"), "yyyy-MM-dd"), "hour": F.date_format(F.col(f"`{ts}`"), "HH")})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = dated.repartitionByRange(parts, "date", "hour", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    # one sort per task keeps a single file open at a time
    spread.sortWithinPartitions("date", "hour").write.mode("append").option(
        "maxRecordsPerFile", file_rows).partitionBy("date", "hour").parquet(path)


def merge_by_day_hour(rows: DataFrame, path: str, keys: Sequence[str], ts: str = "ts") -> None:
    """Bring rows into date/hour directories by key: a row replaces the stored one of its key and hour, others stay.

    Running it twice gives the table of one run. Only hours with new rows are read and written: they are merged, staged in
    the shared folder, and swapped in by a dynamic overwrite, so a job that fails can be run again. Of new rows with one
    key in one hour the smallest in column order counts; null keys are keys of their own value; rows without a time are
    left out. A row that moves to another hour under its key stays in its old hour, too.
    """
    spark = rows.sparkSession
    place = ["date", "hour"]
    dated = rows.where(F.col(f"`{ts}`").isNotNull()).withColumns({
        "date": F.date_format(F.col(f"`{ts}`"), "yyyy-MM-dd"), "hour": F.date_format(F.col(f"`{ts}`"), "HH")})
    rest = [c for c in rows.columns if c not in keys]
    one = dated.groupBy(*place, *keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    new = freeze(one.select(*place, *keys, *[F.col("_row")[c].alias(c) for c in rest]))
    merged = new
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    else:
        stored = stored.withColumns({"date": F.date_format("date", "yyyy-MM-dd"), "hour": F.lpad(F.col("hour").cast("string"), 2, "0")})
        touched = new.select(*[F.col(c).alias(f"_{c}") for c in place]).distinct()
        old = stored.join(touched, (F.col("date") == F.col("_date")) & (F.col("hour") == F.col("_hour")), "left_semi")
        replaced = new.select(*[F.col(c).alias(f"_{c}") for c in (*place, *keys)])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*place, *keys)])
        merged = new.unionByName(old.join(replaced, same, "left_anti").select(new.columns))
    staged = freeze(merged)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged.repartitionByRange(parts, *place, F.xxhash64(*keys)).sortWithinPartitions(*place).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*place).parquet(path)


def transform_by_key_partition(rows: DataFrame, keys: Sequence[str], fn: Callable[[DataFrame], DataFrame], path: str,
                               partitions: int = 10) -> DataFrame:
    """Apply a DataFrame function and store its result in `partitions` directories, whole key groups together.

    The function sees the whole table: a Spark plan is split by its own shuffles, not by hand.
    """
    done = fn(rows)
    numbered = done.withColumn("partition", F.pmod(F.hash(*keys), F.lit(partitions)))
    numbered.write.mode("overwrite").partitionBy("partition").parquet(path)
    return rows.sparkSession.read.parquet(path).drop("partition")


def sink_parquet_by_date(rows: DataFrame, path: str, ts: str = "timestamp") -> None:
    """One directory per day."""
    rows.withColumn("date", F.to_date(ts)).write.mode("overwrite").partitionBy("date").parquet(path)


def sink_parquet_single(rows: DataFrame, path: str) -> None:
    """One file, for a day's result of known small size; larger tables go to `sink_parquet_by_date`."""
    rows.repartition(1).write.mode("overwrite").parquet(path)


def sink_csv_answers(answers: DataFrame, path: str) -> None:
    """Answer sheet with a header, in scenario order (a few hundred rows)."""
    answers.select("scenario_name", "icao", "holding_point", "runway", "time_to_takeoff_s").repartition(
        1).sortWithinPartitions("scenario_name").write.mode("overwrite").csv(path, header=True)
