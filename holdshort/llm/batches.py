"""Arrow batches in small slices, so that a task holds few texts as Python objects at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame

SLICE_ROWS = 128


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_columns(df: DataFrame, fill, **added: Column) -> DataFrame:
    """The table with columns that `fill` puts behind those of its batches; the given values state their types.

    Tasks see the columns under other names, because Spark's own call does not take names with dots.
    """
    numbers = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    filled = numbers.mapInArrow(fill, numbers.select("*", *[value.alias(f"a{i}") for i, value in enumerate(added.values())]).schema)
    return filled.toDF(*df.columns, *added)
