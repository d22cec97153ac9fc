"""Column kinds, feature vectors and wide encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdshort.operators.spread import number_rows, spread_join


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Names of string, numeric and boolean columns; times and the excluded ones are left out."""
    kinds = {"categorical": [], "numeric": [], "boolean": []}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            kinds["boolean"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            kinds["numeric"].append(f.name)
    return kinds


def booleans_to_int(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = column_kinds(df)["boolean"] if columns is None else columns
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def _indexers(columns):
    # one pass for all columns; alphabetical order does not depend on how rows are distributed, frequency ties do
    return [StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep",
                          stringOrderType="alphabetAsc")] if columns else []


def feature_pipeline_lr(categorical: Sequence[str], numeric: Sequence[str], boolean: Sequence[str] = ()) -> Pipeline:
    """Index and one-hot categories, index booleans, standardise numbers; rows with invalid values are skipped.

    Booleans must be strings or numbers for indexing: cast them first (`booleans_to_int`).
    """
    stages, parts = _indexers([*categorical, *boolean]), []
    if categorical:
        stages.append(OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical]))
    if numeric:
        stages += [
            VectorAssembler(inputCols=list(numeric), outputCol="numeric_features", handleInvalid="skip"),
            StandardScaler(inputCol="numeric_features", outputCol="scaled_features", withMean=True, withStd=True),
        ]
        parts.append("scaled_features")
    parts += [f"{c}_ohe" for c in categorical] + [f"{c}_index" for c in boolean]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="skip"))
    return Pipeline(stages=stages)


def feature_pipeline_minmax(categorical: Sequence[str], numeric: Sequence[str], one_hot: bool = True) -> Pipeline:
    """Index (and one-hot) categories, then scale everything to 0 … 1."""
    stages, inputs = _indexers(categorical), [f"{c}_index" for c in categorical]
    if one_hot and categorical:
        stages.append(OneHotEncoder(inputCols=inputs, outputCols=[f"{c}_ohe" for c in categorical]))
        inputs = [f"{c}_ohe" for c in categorical]
    stages += [VectorAssembler(inputCols=[*inputs, *numeric], outputCol="features_raw", handleInvalid="keep"),
               MinMaxScaler(inputCol="features_raw", outputCol="features")]
    return Pipeline(stages=stages)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def features_to_array(df: DataFrame, column: str = "features", out: str = "features_array") -> DataFrame:
    return df.withColumn(out, vector_to_array(column))


def vocabulary(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a category column, for the wide form whose columns they become.

    A column with so many values that they do not fit a table's header goes into `one_hot_sparse` instead.
    """
    return [r[0] for r in df.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct().sort(column).toLocalIterator()]


def one_hot_sparse(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Replace a category column by a sparse 0/1 vector: size, indices and values, for any number of categories.

    `codes` is the table of `label_codes`, built on the training rows; unknown and null values give the zero vector.
    """
    size = codes.agg(F.count(F.lit(1)).cast("int")).scalar()
    known = F.col(f"{column}_code").isNotNull()
    none = lambda kind: F.array().cast(f"array<{kind}>")
    return spread_join(df, codes, [column], "left").withColumn(column, F.struct(
        size.alias("size"), F.when(known, F.array(f"{column}_code")).otherwise(none("int")).alias("indices"),
        F.when(known, F.array(F.lit(1.0))).otherwise(none("double")).alias("values"))).select(*df.columns)


def one_hot_wide(df: DataFrame, columns: Sequence[str], vocabularies: dict[str, list[str]], drop_first: bool = False) -> DataFrame:
    """Replace category columns by 0/1 columns `<column>_<value>` for the given values.

    Train and test share one vocabulary, so they always have the same columns.
    """
    flags = [
        F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns for v in vocabularies[c][1 if drop_first else 0:]
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *flags)


def align_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns missing on one side are added there as 0, in one column order."""
    names = [*left.columns, *[c for c in right.columns if c not in left.columns]]
    fill = lambda df: df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in names])
    return fill(left), fill(right)


def fit_standard(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column gets deviation 1."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def label_codes(train: DataFrame, label: str) -> DataFrame:
    """(label, code): codes 0, 1, … in alphabetical order of the distinct labels."""
    found = train.where(F.col(label).isNotNull()).select(label).distinct()
    numbered = number_rows(found, [label], name="_n")
    return numbered.select(label, (F.col("_n") - 1).cast("int").alias(f"{label}_code"))


def label_encode(rows: DataFrame, codes: DataFrame, label: str) -> DataFrame:
    return spread_join(rows, codes, [label], "left")


def row_id(rows: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Repeatable surrogate id: row number, from 0, in a total order."""
    return number_rows(rows, list(order), name="_n").withColumn(name, F.col("_n") - 1).drop("_n")
