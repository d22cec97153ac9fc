"""Queries run where the workers cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"

JOB = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", {shared!r}).config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()

def here(rows):
    try:
        import holdshort
        yield 1
    except ModuleNotFoundError:
        yield 0

assert spark.sparkContext.parallelize([1], 1).mapPartitions(here).collect() == [0]
import __spark_entry__ as entry
for name, query in entry.queries().items():
    if name.split("_")[0] in ("op1", "op5", "op6", "op7", "op11", "op12", "op13"):
        assert query(spark, {sf!r}).count() > 0
        print("ran", name)
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_workers_need_not_have_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", JOB.format(repo=str(REPO), shared=str(tmp_path / "shared"), sf=SF)], cwd=tmp_path,
                          env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("ran") == 7
