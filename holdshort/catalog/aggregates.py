"""Counts, heat maps, reports, histograms and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort.catalog import query
from holdshort.catalog.joins import STATES, states
from holdshort.catalog.sql import ERR, MSG, WAITS
from holdshort.catalog.tables import messages, table, wait_rows
from holdshort.operators import projections, reports, statistics


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("flight_status_counts", f"WITH {STATES} SELECT hour(ts) AS hour, flight_status, count(DISTINCT callsign) AS count_nonzero FROM st GROUP BY ALL")
def _flight_status_counts(spark, sf):
    return statistics.flight_status_counts(states(spark, sf))


@query("hourly_status_rows", f"WITH {MSG} SELECT hour(ts) AS hour, flight_status, count(flight_status) AS n FROM msg GROUP BY ALL")
def _hourly_status_rows(spark, sf):
    return statistics.hourly_status_rows(messages(spark, sf))


@query("flight_stats", f"""WITH {STATES}, c AS (SELECT strftime(ts, '%a') AS day_of_week, hour(ts) AS hour, count(DISTINCT callsign) AS n FROM st
  WHERE flight_status = 'airborne' GROUP BY ALL)
SELECT day_of_week, max(n) AS max_count, min(n) AS min_count, round(avg(n), 6) AS avg_count,
  (SELECT hour FROM c d WHERE d.day_of_week = c.day_of_week ORDER BY n DESC, hour LIMIT 1) AS max_hour,
  (SELECT hour FROM c d WHERE d.day_of_week = c.day_of_week ORDER BY n, hour LIMIT 1) AS min_hour FROM c GROUP BY day_of_week""")
def _flight_stats(spark, sf):
    counts = statistics.flight_status_counts(states(spark, sf), ["day_of_week", "hour"])
    return rounded(statistics.flight_stats(counts, "airborne"), "avg_count")


HOURS_SQL = ", ".join(f"round(avg(CASE WHEN h = {h} THEN v END), 6) AS h{h:02d}" for h in range(24))


@query("wait_heatmap", f"WITH {WAITS}, x AS (SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, hour AS h, takeoff_time AS v FROM wr) SELECT date, {HOURS_SQL} FROM x GROUP BY 1")
def _wait_heatmap(spark, sf):
    out = statistics.wait_heatmap(wait_rows(spark, sf), "timestamp", "takeoff_time")
    return rounded(out, *[f"h{h:02d}" for h in range(24)]).withColumn("date", F.col("date").cast("string"))


@query("class_distribution", "SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1")
def _class_distribution(spark, sf):
    return rounded(statistics.class_distribution(table(spark, sf, "orders"), "o_orderpriority"), "share")


TRAIN = "1999-01-01"


@query("top_k_else_other", f"""WITH t AS (SELECT p_brand FROM part WHERE p_size < 25 GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 7)
SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM t) THEN p_brand ELSE 'other' END AS p_brand_grouped FROM part""")
def _top_k_else_other(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return statistics.top_k_else_other(part.where("p_size < 25"), part, "p_brand").select("p_partkey", "p_brand_grouped")


@query("class_weights", """WITH w AS (SELECT o_orderpriority, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderpriority, weight FROM orders JOIN w USING (o_orderpriority)""")
def _class_weights(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rounded(statistics.with_class_weights(orders, statistics.class_weights(orders, "o_orderpriority"), "o_orderpriority"), "weight")


REPORT = f"""{ERR}, rep AS (SELECT CASE WHEN grouping(runway) = 0 THEN 'runway' WHEN grouping(holding_point) = 0 THEN 'holding_point' ELSE 'all' END AS scope,
  coalesce(runway, holding_point) AS key, count(*) AS n, avg(abs_error) AS mae, avg(squared_error) AS mse, sqrt(avg(squared_error)) AS rmse,
  CASE WHEN grouping(runway) = 1 AND grouping(holding_point) = 1 THEN 1 - sum(squared_error) / (sum(takeoff_time * takeoff_time) - count(*) * pow(avg(takeoff_time), 2)) END AS r2,
  CASE WHEN grouping(runway) = 1 AND grouping(holding_point) = 1 THEN avg(mape) END AS mape
  FROM er GROUP BY GROUPING SETS ((), (runway), (holding_point)))"""


@query("regression_report", f"""WITH {REPORT} SELECT scope, key, n, round(mae, 5) AS mae, round(mse, 5) AS mse, round(rmse, 5) AS rmse, round(r2, 5) AS r2, round(mape, 5) AS mape FROM rep""")
def _regression_report(spark, sf):
    return rounded(reports.regression_report(wait_rows(spark, sf)), "mae", "mse", "rmse", "r2", "mape", digits=5)


@query("metrics_long", f"""WITH {REPORT}, l AS (UNPIVOT (SELECT scope, key, mae, rmse, mse, r2, mape FROM rep) ON mae, rmse, mse, r2, mape INTO NAME measure VALUE value)
SELECT CASE WHEN scope = 'all' THEN measure || '_test' ELSE measure || '_test_' || CASE scope WHEN 'holding_point' THEN 'hp' ELSE scope END || '_' || key END AS metric,
  round(value, 5) AS value FROM l WHERE value IS NOT NULL AND (scope = 'all' OR measure IN ('mae', 'rmse'))""")
def _metrics_long(spark, sf):
    return rounded(reports.metrics_long(reports.regression_report(wait_rows(spark, sf))), "value", digits=5)


@query("error_heatmap", f"""WITH {ERR}, x AS (SELECT weekday, hour AS h, abs_error AS v FROM er) SELECT weekday, {HOURS_SQL},
  list_position(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], weekday) AS day_order FROM x GROUP BY weekday""")
def _error_heatmap(spark, sf):
    return rounded(reports.error_heatmap(wait_rows(spark, sf)), *[f"h{h:02d}" for h in range(24)])


@query("error_by_weekday_hour", f"WITH {ERR} SELECT weekday, hour, round(avg(abs_error), 6) AS mae, round(sqrt(avg(squared_error)), 6) AS rmse FROM er GROUP BY ALL")
def _error_by_weekday_hour(spark, sf):
    return rounded(reports.error_by_weekday_hour(wait_rows(spark, sf)), "mae", "rmse")


@query("error_by_day", f"WITH {ERR} SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, round(avg(abs_error), 6) AS mae, round(sqrt(avg(squared_error)), 6) AS rmse FROM er GROUP BY 1")
def _error_by_day(spark, sf):
    return rounded(reports.error_by_day(wait_rows(spark, sf)), "mae", "rmse").withColumn("date", F.col("date").cast("string"))


BOX = "round(min(v), 6) AS low, round(quantile_cont(v, 0.25), 6) AS q1, round(median(v), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS high"


@query("error_by_category", f"""WITH {ERR}, x AS (SELECT 'turbulence_category' AS category_type, turbulence_category AS category_value, error AS v FROM er
  UNION ALL SELECT 'last_event_turb_cat', last_event_turb_cat, error FROM er) SELECT category_type, category_value, {BOX} FROM x GROUP BY ALL""")
def _error_by_category(spark, sf):
    return rounded(reports.error_by_category(wait_rows(spark, sf)), "low", "q1", "median", "q3", "high")


@query("box_stats", f"WITH x AS (SELECT o_orderstatus, o_totalprice AS v FROM orders) SELECT o_orderstatus, {BOX} FROM x GROUP BY 1")
def _box_stats(spark, sf):
    return rounded(statistics.box_stats(table(spark, sf, "orders"), "o_totalprice", ["o_orderstatus"]), "low", "q1", "median", "q3", "high")


def _histogram_sql(source, value, bins, by=""):
    keys = f"{by}, " if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return f"""WITH x AS (SELECT {keys}{value} AS v, min({value}) OVER ({over}) AS lo, max({value}) OVER ({over}) AS hi FROM {source}),
y AS (SELECT *, least(CAST(floor((v - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}) AS bin FROM x)
SELECT {keys}bin, round(lo + bin * (hi - lo) / {bins}, 4) AS bin_low, count(*) AS n FROM y GROUP BY {keys}bin, lo, hi"""


@query("histogram", _histogram_sql("orders", "o_totalprice", 20))
def _histogram(spark, sf):
    return rounded(statistics.histogram(table(spark, sf, "orders"), "o_totalprice", 20), "bin_low", digits=4)


@query("histogram_by_group", _histogram_sql("(SELECT o_orderstatus, ln(1 + o_totalprice) AS lp FROM orders)", "lp", 30, "o_orderstatus"))
def _histogram_by_group(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", F.log(1 + F.col("o_totalprice")).alias("lp"))
    return rounded(statistics.histogram(rows, "lp", 30, ["o_orderstatus"]), "bin_low", digits=4)


@query("error_histogram", f"""WITH {ERR}, x AS (SELECT error AS v, min(error) OVER () AS lo, max(error) OVER () AS hi FROM er),
y AS (SELECT *, least(CAST(floor((v - lo) / ((hi - lo) / 100)) AS INTEGER), 99) AS bin FROM x)
SELECT bin, round(lo + bin * (hi - lo) / 100, 4) AS bin_low, count(*) AS n FROM y GROUP BY bin, lo, hi""")
def _error_histogram(spark, sf):
    return rounded(reports.error_histogram(wait_rows(spark, sf), 100), "bin_low", digits=4)


def classified(spark, sf):
    """Order status against a guess from the price."""
    codes = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return table(spark, sf, "orders").select(codes.alias("label"), (F.floor(F.col("o_totalprice")) % 3).cast("int").alias("prediction"))


CLS = """cl AS (SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label, CAST(CAST(floor(o_totalprice) AS BIGINT) % 3 AS INTEGER) AS prediction FROM orders)"""


@query("confusion_matrix", f"WITH {CLS} SELECT label, prediction, count(*) AS n FROM cl GROUP BY ALL")
def _confusion_matrix(spark, sf):
    return reports.confusion_matrix(classified(spark, sf))


@query("classification_report", f"""WITH {CLS}, per AS (SELECT CAST(c AS VARCHAR) AS class, count(*) FILTER (WHERE label = c AND prediction = c) AS tp,
  count(*) FILTER (WHERE prediction = c) AS hits, count(*) FILTER (WHERE label = c) AS support FROM cl, (VALUES (0), (1), (2)) v(c) GROUP BY c),
m AS (SELECT class, tp / hits AS precision, tp / support AS recall, 2.0 * tp / (hits + support) AS f1, support, tp FROM per)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m
UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m""")
def _classification_report(spark, sf):
    return rounded(reports.classification_report(classified(spark, sf)), "precision", "recall", "f1")


BINARY = "bi AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS score FROM lineitem)"


def binary(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"), F.col("l_extendedprice").alias("score"))


@query("roc_points", f"""WITH {BINARY}, c AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM bi GROUP BY 1)
SELECT score AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
  round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr FROM c WINDOW w AS (ORDER BY score DESC)""")
def _roc_points(spark, sf):
    return rounded(reports.roc_points(binary(spark, sf)), "tpr", "fpr").drop("pos", "neg")


@query("auc", f"""WITH {BINARY}, r AS (SELECT label, avg(rn) OVER (PARTITION BY score) AS mid FROM (SELECT *, row_number() OVER (ORDER BY score) AS rn FROM bi)),
s AS (SELECT sum(mid) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM r)
SELECT round((rs - p * (p + 1) / 2) / (p * n), 6) AS auc FROM s""")
def _auc(spark, sf):
    return rounded(reports.auc(binary(spark, sf)), "auc")


@query("exact_quantiles", """SELECT prob, round(CASE prob WHEN 0.75 THEN quantile_cont(o_totalprice, 0.75) WHEN 0.9 THEN quantile_cont(o_totalprice, 0.9) ELSE quantile_cont(o_totalprice, 0.99) END, 6) AS value
  FROM orders, (VALUES (0.75e0), (0.9e0), (0.99e0)) v(prob) GROUP BY prob""")
def _exact_quantiles(spark, sf):
    return rounded(statistics.exact_quantiles(table(spark, sf, "orders"), "o_totalprice", [0.75, 0.9, 0.99]), "value")


@query("quantile_cutoff")
def _quantile_cutoff(spark, sf):
    orders = table(spark, sf, "orders")
    cutoff = statistics.quantile_cutoff(orders, "o_totalprice")
    share = F.avg((F.col("o_totalprice") <= cutoff).cast("double"))
    return orders.agg(F.lit(cutoff).alias("cutoff"), F.round(share, 2).alias("share"))


@query("quantile_cutoff_exact", "SELECT quantile_disc(o_totalprice, 0.75)::DOUBLE AS cutoff, quantile_disc(o_totalprice, 0.5)::DOUBLE AS middle FROM orders")
def _quantile_cutoff_exact(spark, sf):
    orders = table(spark, sf, "orders")
    cutoff, middle = (statistics.quantile_cutoff(orders, "o_totalprice", p, 0.0) for p in (0.75, 0.5))
    return orders.agg(F.lit(cutoff).cast("double").alias("cutoff"), F.lit(middle).cast("double").alias("middle"))


@query("max_timestamp", f"WITH {WAITS} SELECT epoch_us(max(timestamp)) AS max_ts FROM wr")
def _max_timestamp(spark, sf):
    return projections.max_timestamp(wait_rows(spark, sf), "timestamp").withColumn("max_ts", F.unix_micros("max_ts"))
