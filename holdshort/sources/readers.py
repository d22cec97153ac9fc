"""Readers with fixed schemas; nothing is inferred from data that may be large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdshort.schemas import RAW_MESSAGE
from holdshort.sources.rejects import LINE, REASON


def scan_messages_csv(spark: SparkSession, path: str) -> DataFrame:
    """Distinct rows of `;`-separated message logs with a header; a trailing junk column is ignored."""
    # the third name takes up the empty field after a closing separator
    schema = T.StructType([*RAW_MESSAGE.fields, T.StructField("_junk", T.StringType())])
    rows = spark.read.csv(path, schema=schema, sep=";", header=True, enforceSchema=True)
    return rows.select("message", "ts_kafka").distinct()


def scan_parquet_projected(spark: SparkSession, pattern: str, columns: Sequence[str], ts: str) -> DataFrame:
    """Chosen columns of all matching files with an hour label and a weekday."""
    rows = spark.read.parquet(pattern).select(*[F.col(f"`{c}`") for c in columns])
    return rows.withColumn(ts, F.col(f"`{ts}`").cast("timestamp")).withColumns({
        "hour": F.date_format(F.col(f"`{ts}`"), "yyyy-MM-dd HH:00:00"),
        "day_of_week": F.date_format(F.col(f"`{ts}`"), "E"),
    })


def consolidate_parquet(spark: SparkSession, directory: str, schema: T.StructType | None = None) -> DataFrame:
    """All parquet files below a directory as one table; columns missing in some files are null."""
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    return reader.parquet(directory)


def scan_meteo_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Hourly weather files: some lines above the header, a `time` column, all other columns numbers.

    The header is the line with a field `time`; each file has its own, so files may differ in columns and their order, and
    a column that a file lacks is null there. Files are a bounded dimension (one row per hour): their names and headers
    reach the driver. Lines above the header fail to parse as times and are dropped with it; `mark_meteo_csv` keeps them.
    """
    return mark_meteo_csv(spark, path, columns).where(F.col(REASON).isNull()).drop(LINE, REASON)


def mark_meteo_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All lines of weather files that are not blank, with `_reason` for those without a time: `header`, else `time`."""
    if columns is not None:
        headers = {path: list(columns)}
    else:
        lines = spark.read.text(path).where(F.col("value").rlike(r"(^|,)time(,|$)"))
        headers = {r.file: r.head.split(",") for r in lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min("value").alias("head")).collect()}
    files: dict[tuple[str, ...], list[str]] = {}
    for file, names in sorted(headers.items()):
        files.setdefault(tuple(names), []).append(file)
    parts = []
    for names, paths in files.items():
        fields = [T.StructField(c, T.StringType() if c == "time" else T.DoubleType()) for c in names]
        schema = T.StructType([*fields, T.StructField(LINE, T.StringType())])
        rows = spark.read.option("columnPruning", "false").csv(
            paths, schema=schema, header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        reason = F.when(F.col("time") == "time", "header").when(F.expr("try_to_timestamp(time)").isNull(), "time")
        # the parser gives the line only if it cannot read all fields
        parts.append(rows.withColumns({REASON: reason, LINE: F.coalesce(LINE, "time"), "time": F.expr("try_to_timestamp(time)")}))
    if not parts:
        raise ValueError(f"no line of {path} has a field named time")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Columns of the aircraft registry that are kept.
AIRCRAFT_COLUMNS = ["icao24", "engines", "manufacturerName", "model", "operator"]


def scan_aircraft_db(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft registry with single-quoted names and values: quotes are stripped, an empty value is null, the first
    character of `engines` gives the engine count, addresses are upper case, malformed lines are dropped;
    `mark_aircraft_db` keeps them."""
    return mark_aircraft_db(spark, path).where(F.col(REASON).isNull()).drop(LINE, REASON)


def mark_aircraft_db(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a registry, with `_reason` `fields` for those with too many or too few fields."""
    names = spark.read.csv(path, header=True, quote='"').columns
    fields = [T.StructField(c, T.StringType()) for c in [*names, "_malformed"]]
    # without pruning every field is parsed; otherwise a line with too many or too few fields passes if only some are read
    raw = spark.read.option("columnPruning", "false").csv(path, schema=T.StructType(fields), header=True, mode="PERMISSIVE", quote='"',
                         columnNameOfCorruptRecord="_malformed")
    rows = raw.toDF(*[c.replace("'", "") for c in names], LINE).select(*AIRCRAFT_COLUMNS, LINE)
    clean = rows.select(*[
        F.when(F.col(c) != "''", F.regexp_replace(c, "'", "")).alias(c) for c in AIRCRAFT_COLUMNS],
        LINE, F.when(F.col(LINE).isNotNull(), "fields").alias(REASON))
    count = F.regexp_extract(F.trim("engines"), r"^(\d)", 1)
    return clean.withColumns({
        "icao24": F.upper("icao24"), "num_engines": F.when(count != "", count.cast("int")),
    }).drop("engines")


def scan_geojson(spark: SparkSession, path: str, properties: Sequence[str], point: bool = True) -> DataFrame:
    """Features of a FeatureCollection: properties and coordinates, as lon/lat or as a ring of points."""
    shape = "array<double>" if point else "array<array<array<double>>>"
    props = ",".join(f"{p}:string" for p in properties)
    schema = f"features array<struct<properties:struct<{props}>,geometry:struct<type:string,coordinates:{shape}>>>"
    found = spark.read.json(path, schema=schema, multiLine=True).select(F.explode("features").alias("f"))
    at = F.col("f.geometry.coordinates")
    if point:
        where = [at[0].alias("lon"), at[1].alias("lat")]
    else:
        where = [F.transform(at[0], lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))).alias("ring")]
    return found.select(*[F.col(f"f.properties.{p}").alias(p.lower()) for p in properties], *where)
