"""Keyed partition merges and quantile sketches against plain computations."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from holdshort.features import quantiles
from holdshort.sources import writers


def test_merge_replaces_by_key_and_can_be_run_again(spark, table, tmp_path):
    path = f"{tmp_path}/merged"
    first = table([(1, 10.0, "a"), (2, 20.0, "b"), (2, 20.0, "c"), (None, 30.0, "n"), (3, 7200.0, "far"), (4, None, "no time")], "id long, ts ts, v string")
    later = table([(1, 11.0, "A"), (5, 40.0, "e"), (None, 31.0, None)], "id long, ts ts, v string")

    def stored():
        return sorted(((r.id, r.v, r.hour) for r in spark.read.parquet(path).collect()), key=repr)

    for _ in range(2):
        writers.merge_by_day_hour(first, path, ["id"])
        assert stored() == sorted([(1, "a", 0), (2, "b", 0), (None, "n", 0), (3, "far", 2)], key=repr)
    for _ in range(2):
        writers.merge_by_day_hour(later, path, ["id"])
        assert stored() == sorted([(1, "A", 0), (2, "b", 0), (None, None, 0), (3, "far", 2), (5, "e", 0)], key=repr)
    writers.merge_by_day_hour(later.limit(0), path, ["id"])
    assert len(stored()) == 5


def test_fold_cutoffs_from_day_sketches(spark):
    start = datetime(2024, 1, 1)
    rows = spark.range(20000).select(
        F.timestamp_seconds(F.lit(start.timestamp()) + F.col("id") * 60).alias("timestamp"), ((F.col("id") * 7919) % 20011).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (start, None)], "timestamp timestamp, v long"))
    ends = [start + timedelta(days=d) for d in (0, 3, 9)]
    found = {r.fold: r for r in quantiles.fold_cutoffs(quantiles.day_sketches(rows, "v"), ends, 0.75).collect()}
    assert sorted(found) == [1, 2]
    for fold, r in found.items():
        values = sorted(x.v for x in rows.where(F.col("timestamp") < F.lit(ends[fold])).where("v IS NOT NULL").collect())
        assert r.n == len(values) and abs(sum(v <= r.cutoff for v in values) / len(values) - 0.75) < 0.01
    assert quantiles.fold_cutoffs(quantiles.day_sketches(rows.limit(0), "v"), ends).collect() == []
