"""Readers and writers, round trips through the shared folder with tables of full size."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.cleaning import answer_sheet
from holdshort.catalog.decoding import raw_frames
from holdshort.catalog.sql import MSG
from holdshort.catalog.tables import messages, pick, table
from holdshort.operators import decoding, scenarios
from holdshort.session import scratch_path
from holdshort.sources import readers, writers
from holdshort.sources.rejects import split_rejects


@query("scan_messages_csv", "SELECT 1700000000000 + event_id * 977 AS ts_kafka, CASE WHEN event_id % 50 = 0 THEN 13 WHEN event_id % 6 < 4 THEN 20 ELSE 12 END AS length FROM events")
def _scan_messages_csv(spark, sf):
    path = scratch_path(spark, "messages")
    rows = raw_frames(spark, sf).select("message", "ts_kafka", F.lit(None).cast("string").alias("junk"))
    rows.unionByName(rows).write.csv(path, sep=";", header=True)
    return readers.scan_messages_csv(spark, path).select("ts_kafka", F.length("message").alias("length"))


@query("scan_parquet_projected", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:00:00') AS hour, strftime(ts, '%a') AS day_of_week FROM events")
def _scan_parquet_projected(spark, sf):
    return readers.scan_parquet_projected(spark, f"{sf}/event*.parquet", ["event_id", "ts"], "ts").drop("ts")


@query("partition_by_day_hour", "SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(strftime(ts, '%H') AS INTEGER) AS hour, 2 * count(*) AS n, 2 * sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL")
def _partition_by_day_hour(spark, sf):
    path = scratch_path(spark, "by-hour")
    rows = table(spark, sf, "events").select("event_id", "ts")
    writers.partition_by_day_hour(rows, path)
    writers.partition_by_day_hour(rows, path)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date"), "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("merge_by_day_hour", """SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(strftime(ts, '%H') AS INTEGER) AS hour, count(*) AS n,
  sum(event_id)::BIGINT AS ids, round(sum(CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END), 4) AS total FROM events GROUP BY ALL""")
def _merge_by_day_hour(spark, sf):
    """The same rows twice, then a correction of some of them."""
    path = scratch_path(spark, "merged")
    rows = table(spark, sf, "events").select("event_id", "ts", "value")
    writers.merge_by_day_hour(rows, path, ["event_id"])
    writers.merge_by_day_hour(rows, path, ["event_id"])
    writers.merge_by_day_hour(rows.where("event_id % 10 = 0").withColumn("value", F.col("value") + 1), path, ["event_id"])
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date"), "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 4).alias("total"))


@query("consolidate_parquet", "SELECT event_type, event_id, CASE WHEN event_type IN ('click', 'view') THEN value END AS value FROM events")
def _consolidate_parquet(spark, sf):
    path = scratch_path(spark, "parts")
    rows = table(spark, sf, "events").select("event_type", "event_id", "value")
    seen = F.col("event_type").isin("click", "view")
    rows.where(seen).write.parquet(f"{path}/a")
    rows.where(~seen).drop("value").write.parquet(f"{path}/b")
    return readers.consolidate_parquet(spark, path)


@query("transform_by_key_partition", f"WITH {MSG} SELECT icao, count(*) AS n, CAST(sum(typecode) AS BIGINT) AS total FROM msg GROUP BY 1")
def _transform_by_key_partition(spark, sf):
    def summarise(df):
        return df.groupBy("icao").agg(F.count(F.lit(1)).alias("n"), F.sum("typecode").cast("long").alias("total"))

    return writers.transform_by_key_partition(messages(spark, sf), ["icao"], summarise, scratch_path(spark, "by-key"))


@query("scan_meteo_csv", f"""SELECT epoch_us(date_trunc('hour', ts)) AS time, CAST(count(*) AS DOUBLE) AS "cloud_cover (%)", min(value) AS "temperature_2m (°C)" FROM events GROUP BY 1""")
def _scan_meteo_csv(spark, sf):
    rows = readers.scan_meteo_csv(spark, weather_files(spark, sf))
    return rows.withColumn("time", F.unix_micros(F.col("time").cast("timestamp")))


def weather_files(spark, sf):
    path = scratch_path(spark, "weather")
    hourly = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("v"))
    names = {"time": F.date_format("t", "yyyy-MM-dd'T'HH:mm"), "cloud_cover (%)": F.col("n").cast("string"), "temperature_2m (°C)": F.col("v").cast("string")}
    # two files whose headers have another order
    for order, half in ((list(names), "hour(t) < 12"), (list(names)[::-1], "hour(t) >= 12")):
        lines = hourly.where(half).select(F.lit(1).alias("k"), F.concat_ws(",", *[names[c] for c in order]).alias("value"))
        head = spark.createDataFrame([
            (-3, "latitude,longitude"), (-2, "40.53,-3.56"), (-1, ""), (0, ",".join(order))], "k int, value string")
        head.unionByName(lines).repartition(1).sortWithinPartitions("k").select("value").write.mode("append").text(path)
    return path


@query("scan_aircraft_db", """SELECT printf('%X', c_custkey + 40960) AS icao24, 'Maker ' || (c_custkey % 7) AS manufacturerName, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'M' || c_custkey END AS model,
  c_mktsegment AS operator, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 4 + 1 END AS num_engines FROM customer""")
def _scan_aircraft_db(spark, sf):
    return readers.scan_aircraft_db(spark, registry_files(spark, sf))


def registry_files(spark, sf):
    path = scratch_path(spark, "registry")
    k = F.col("c_custkey")
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    rows = table(spark, sf, "customer").select(
        quoted(F.lower(F.hex(k + 40960))).alias("'icao24'"),
        quoted(F.when(k % 3 == 0, "").otherwise(F.concat((k % 4 + 1).cast("string"), F.lit(" TURBO")))).alias("'engines'"),
        quoted(F.concat(F.lit("Maker "), (k % 7).cast("string"))).alias("'manufacturerName'"),
        quoted(F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("M"), k.cast("string")))).alias("'model'"),
        quoted(F.col("c_mktsegment")).alias("'operator'"), quoted(F.col("c_name")).alias("'owner'"))
    rows.write.csv(path, header=True)
    # lines with surplus and with missing fields do not count
    bad = ["'ffff01','1','Maker','M','op','x','y','z'", "'ffff02','1'"]
    spark.createDataFrame([(line,) for line in [",".join(rows.columns), *bad]], "value string").coalesce(1).write.mode("append").text(path)
    return path


@query("rejected_lines", """SELECT 'registry' AS source, 'fields' AS reason, 2 AS n, count(*) + 2 AS n_read, count(*) AS n_accepted FROM customer
UNION ALL SELECT 'frames', 'frame', count(*) FILTER (WHERE event_id % 50 = 0), count(*), count(*) FILTER (WHERE event_id % 50 <> 0) FROM events
UNION ALL SELECT 'weather', reason, n, (SELECT count(DISTINCT date_trunc('hour', ts)) + 6 FROM events), (SELECT count(DISTINCT date_trunc('hour', ts)) FROM events)
  FROM (VALUES ('header', 2), ('time', 4)) h(reason, n)""")
def _rejected_lines(spark, sf):
    """Rejected rows by reason beside the rows read, as observed, and the accepted ones."""
    from holdshort.catalog.decoding import decoded

    parts = []
    for source, marked in (("registry", readers.mark_aircraft_db(spark, registry_files(spark, sf))),
                           ("weather", readers.mark_meteo_csv(spark, weather_files(spark, sf))),
                           ("frames", decoding.mark_unreadable(decoded(spark, sf)))):
        found = split_rejects(marked)
        parts.append(found.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).join(
            F.broadcast(found.accepted.agg(F.count(F.lit(1)).alias("n_accepted")))).select(
            F.lit(source).alias("source"), "reason", "n", F.lit(found.read).cast("long").alias("n_read"), "n_accepted"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("scan_geojson", "SELECT 'P' || s_suppkey AS designator, CAST(s_nationkey AS VARCHAR) AS runway, round(s_suppkey / 8, 4) AS lon, round(s_suppkey / 4, 4) AS lat FROM supplier")
def _scan_geojson(spark, sf):
    path = scratch_path(spark, "geojson")
    k = F.col("s_suppkey")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("P"), k.cast("string")).alias("Designator"), F.col("s_nationkey").cast("string").alias("Runway")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(k / 8, k / 4).alias("coordinates")).alias("geometry"))
    # collections of at most 500 features, one document per file
    table(spark, sf, "supplier").groupBy(F.floor(k / 500).alias("part")).agg(F.collect_list(feature).alias("features")).select(
        "features").write.option("maxRecordsPerFile", 1).json(path)
    out = readers.scan_geojson(spark, path, ["Designator", "Runway"])
    return out.withColumns({"lon": F.round("lon", 4), "lat": F.round("lat", 4)})


@query("sink_parquet_single", f"WITH {MSG} SELECT icao, count(*) AS n FROM msg GROUP BY 1")
def _sink_parquet_single(spark, sf):
    path = scratch_path(spark, "single")
    writers.sink_parquet_single(messages(spark, sf).groupBy("icao").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


@query("sink_parquet_by_date", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n FROM events GROUP BY 1")
def _sink_parquet_by_date(spark, sf):
    path = scratch_path(spark, "by-date")
    writers.sink_parquet_by_date(table(spark, sf, "events"), path, "ts")
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


PREDICTED = f"""pr AS (SELECT 'scenario_' || (user_id % 10) AS scenario_name, CAST(user_id AS VARCHAR) AS icao, user_id % 10 AS s,
  event_id % 2 AS side, ts AS timestamp, value AS prediction FROM events),
asked AS (SELECT scenario_name, s, CAST(min(CAST(icao AS BIGINT)) AS VARCHAR) AS icao FROM pr GROUP BY ALL)"""


def predictions(spark, sf):
    """Scored rows of the ten scenarios: every second row is at the asked holding point."""
    e, s = F.col("event_id"), F.col("user_id") % 10
    points = airport.HOLDING_POINTS
    asked = e % 2 == 0
    return table(spark, sf, "events").select(
        F.concat(F.lit("scenario_"), s.cast("string")).alias("scenario_name"), F.col("user_id").cast("string").alias("icao"),
        F.when(asked, pick([p[0] for p in points], s * 2)).otherwise("??").alias("holding_point"),
        pick([p[1] for p in points], s * 2).alias("runway"), F.col("ts").alias("timestamp"), F.col("value").alias("prediction"))


ANSWERED = f"""WITH {PREDICTED} SELECT a.scenario_name, a.icao, round(coalesce((SELECT prediction FROM pr WHERE pr.scenario_name = a.scenario_name
  AND pr.icao = a.icao AND pr.side = 0 AND a.s <> 3 ORDER BY timestamp DESC LIMIT 1), -1), 4) AS time_to_takeoff_s FROM asked a"""


@query("scenario_answers", ANSWERED)
def _scenario_answers(spark, sf):
    scored = predictions(spark, sf).where("scenario_name <> 'scenario_3'")
    return scenarios.scenario_answers(answer_sheet(spark, sf), scored).select(
        "scenario_name", "icao", F.round("time_to_takeoff_s", 4).alias("time_to_takeoff_s"))


@query("sink_csv_answers", ANSWERED)
def _sink_csv_answers(spark, sf):
    path = scratch_path(spark, "answers")
    scored = predictions(spark, sf).where("scenario_name <> 'scenario_3'")
    writers.sink_csv_answers(scenarios.scenario_answers(answer_sheet(spark, sf), scored), path)
    schema = "scenario_name string, icao string, holding_point string, runway string, time_to_takeoff_s double"
    return spark.read.csv(path, header=True, schema=schema).select(
        "scenario_name", "icao", F.round("time_to_takeoff_s", 4).alias("time_to_takeoff_s"))


@query("scenario_status", f"""WITH {PREDICTED} SELECT scenario_name, CASE s WHEN 0 THEN -1 WHEN 1 THEN -4 WHEN 2 THEN -6 WHEN 3 THEN -7 WHEN 4 THEN -12 WHEN 5 THEN -99 WHEN 6 THEN -5 ELSE 0 END AS status FROM asked""")
def _scenario_status(spark, sf):
    rows = predictions(spark, sf).withColumn("_s", F.substring("scenario_name", 10, 1).cast("int"))
    few = rows.where("_s <> 4").unionByName(rows.where("_s = 4").orderBy("timestamp").limit(3))
    scored = rows.where("_s > 5").withColumn("prediction", F.when(F.col("_s") != 6, F.col("prediction")))
    return scenarios.scenario_status(
        answer_sheet(spark, sf), rows.where("_s > 0"), rows.where("_s > 1"), rows.where("_s > 2"), few.where("_s > 3"), scored, 10)
