"""Splits, folds, encoders and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort.catalog import query
from holdshort.catalog.aggregates import rounded
from holdshort.catalog.cleaning import micros
from holdshort.catalog.sql import WAITS
from holdshort.catalog.tables import table, wait_rows
from holdshort.features import encoders, resampling, splits
from holdshort.features.neighbours import nearest_neighbours
from holdshort.operators.projections import union_all
from holdshort.session import scratch_path

TAG = lambda df, name: df.withColumn("part", F.lit(name))
ORDERS = "o_orderkey", "o_orderdate"


def orders(spark, sf):
    return table(spark, sf, "orders")


@query("time_split", "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-15' THEN 'train' ELSE 'test' END AS part FROM orders")
def _time_split(spark, sf):
    train, test = splits.time_split(orders(spark, sf), "1999-01-15", "o_orderdate")
    return union_all(TAG(train, "train"), TAG(test, "test")).select("o_orderkey", "part")


@query("holdout_split", """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'validation' END AS part FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-15'""")
def _holdout_split(spark, sf):
    train, val = splits.holdout_split(orders(spark, sf), "1999-01-01", "1999-01-14", "o_orderdate")
    return union_all(TAG(train, "train"), TAG(val, "validation")).select("o_orderkey", "part")


FOLDS = [("1996-12-31", "1997-01-01", "1997-03-31"), ("1997-03-31", "1997-04-01", "1997-06-30"), ("1997-06-30", "1997-07-01", "1997-09-30")]


@query("expanding_folds", " UNION ALL ".join(
    f"SELECT {i} AS fold, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) <= '{e}') AS n_train, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN '{a}' AND '{b}') AS n_val FROM orders"
    for i, (e, a, b) in enumerate(FOLDS)))
def _expanding_folds(spark, sf):
    out = []
    for i, (train, val) in enumerate(splits.expanding_folds(orders(spark, sf), FOLDS, "o_orderdate")):
        out += [train.select(F.lit(i).alias("fold"), F.lit(1).alias("t")), val.select(F.lit(i).alias("fold"), F.lit(0).alias("t"))]
    return union_all(*out).groupBy("fold").agg(F.count_if(F.col("t") == 1).alias("n_train"),
                                               F.count_if(F.col("t") == 0).alias("n_val"))


@query("sliding_folds", """WITH b AS (SELECT min(epoch_us(o_orderdate)) AS lo, max(epoch_us(o_orderdate)) AS hi FROM orders),
c AS (SELECT k AS fold, lo + (365 + k * 180) * 86400000000 AS cut FROM b, generate_series(0, 100) g(k) WHERE lo + (k * 180 + 365) * 86400000000 <= hi)
SELECT fold, count(*) FILTER (WHERE epoch_us(o_orderdate) < cut) AS n_train,
  count(*) FILTER (WHERE epoch_us(o_orderdate) >= cut AND epoch_us(o_orderdate) < cut + 180 * 86400000000) AS n_val FROM c, orders GROUP BY fold""")
def _sliding_folds(spark, sf):
    return splits.sliding_fold_sizes(orders(spark, sf), 365, 180, "o_orderdate")


@query("rank_folds", """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders),
s AS (SELECT *, n // 6 AS size, i - (n - 5 * (n // 6)) AS off FROM r) SELECT o_orderkey, CASE WHEN off < 0 THEN 0 ELSE 1 + off // size END AS block FROM s""")
def _rank_folds(spark, sf):
    return splits.with_rank_block(orders(spark, sf).select(*ORDERS), ["o_orderdate", "o_orderkey"], 5).select("o_orderkey", "block")


@query("split_by_quantile")
def _split_by_quantile(spark, sf):
    low, high, _ = splits.split_by_quantile(orders(spark, sf), "o_totalprice")
    return union_all(TAG(low, "low"), TAG(high, "high")).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest"))


@query("column_kinds", """SELECT 'categorical' AS kind, 7 * count(*) AS n FROM lineitem UNION ALL SELECT 'numeric', 6 * count(*) FROM lineitem
  UNION ALL SELECT 'boolean', count(*) FROM lineitem""")
def _column_kinds(spark, sf):
    """Values per kind of column."""
    kinds = encoders.column_kinds(wait_rows(spark, sf))
    filled = {k: sum((F.count(c) for c in v), F.lit(0)) for k, v in kinds.items()}
    return wait_rows(spark, sf).agg(*[n.alias(k) for k, n in filled.items()]).unpivot([], list(kinds), "kind", "n")


@query("booleans_to_int", f"WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, callsign, CAST(is_holiday AS INTEGER) AS is_holiday FROM wr")
def _booleans_to_int(spark, sf):
    return encoders.booleans_to_int(wait_rows(spark, sf).select(micros("timestamp"), "callsign", "is_holiday"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot_wide", "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in PRIORITIES) + " FROM orders")
def _one_hot_wide(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", "o_orderpriority")
    return encoders.one_hot_wide(rows, ["o_orderpriority"], {"o_orderpriority": encoders.vocabulary(rows, "o_orderpriority")})


@query("one_hot_wide_drop_first", "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in PRIORITIES[1:]) + " FROM orders")
def _one_hot_wide_drop(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", "o_orderpriority")
    words = {"o_orderpriority": encoders.vocabulary(rows, "o_orderpriority")}
    return encoders.one_hot_wide(rows, ["o_orderpriority"], words, drop_first=True)


@query("align_columns", """SELECT o_orderkey, 1 AS a, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS b FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 0, 1 FROM orders WHERE o_orderstatus <> 'F'""")
def _align_columns(spark, sf):
    o = orders(spark, sf)
    left = o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit(1).alias("a"))
    right = o.where("o_orderstatus <> 'F'").select("o_orderkey", F.lit(1).alias("b"))
    return union_all(*encoders.align_columns(left, right))


@query("standardise", """WITH t AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-15')
SELECT o_orderkey, round((o_totalprice - m) / s, 5) AS o_totalprice FROM orders, t""")
def _standardise(spark, sf):
    rows = orders(spark, sf).select(*ORDERS, "o_totalprice")
    train, _ = splits.time_split(rows, "1999-01-15", "o_orderdate")
    out = encoders.standardise(rows, encoders.fit_standard(train, ["o_totalprice"]))
    return rounded(out, "o_totalprice", digits=5).drop("o_orderdate")


@query("label_encode", "SELECT o_orderkey, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_code FROM orders")
def _label_encode(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", "o_orderpriority")
    return encoders.label_encode(rows, encoders.label_codes(rows, "o_orderpriority"), "o_orderpriority")


@query("row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders")
def _row_id(spark, sf):
    return encoders.row_id(orders(spark, sf).select(*ORDERS), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_id")


@query("sample_one_per_group", f"WITH {WAITS} SELECT callsign, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, 1 AS n FROM wr GROUP BY ALL")
def _sample_one_per_group(spark, sf):
    rows = wait_rows(spark, sf).withColumn("date", F.to_date("timestamp"))
    out = resampling.sample_one_per_group(rows, ["callsign", "date"])
    return out.groupBy("callsign", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("oversample_to_class", """WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderpriority, CASE WHEN o_orderpriority LIKE '1%' THEN n ELSE (SELECT n FROM c WHERE o_orderpriority LIKE '3%') END AS n FROM c""")
def _oversample(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", "o_orderpriority")
    out = resampling.oversample_to_class(rows, "o_orderpriority", "3-MEDIUM", ["1-URGENT"])
    return out.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def labelled_vectors(spark, sf):
    """Embeddings with three uneven classes."""
    k = F.col("label") % 3
    return table(spark, sf, "embeddings").select("vec_id", F.when(k == 0, 0).otherwise(F.when(F.col("vec_id") % 3 == 0, 1).otherwise(2)).alias("y"),
                                                 F.col("embedding").cast("array<double>").alias("v"))


CLASSES = "lv AS (SELECT vec_id, CASE WHEN label % 3 = 0 THEN 0 WHEN vec_id % 3 = 0 THEN 1 ELSE 2 END AS y, embedding AS v FROM embeddings)"


@query("nearest_neighbours", f"""WITH {CLASSES}, d AS (SELECT a.vec_id, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id
  ORDER BY list_distance(a.v::DOUBLE[], b.v::DOUBLE[]), b.vec_id) AS rank FROM lv a JOIN lv b ON a.y = b.y AND a.vec_id <> b.vec_id)
SELECT vec_id, neighbour, CAST(rank AS INTEGER) AS rank FROM d WHERE rank <= 5""")
def _nearest_neighbours(spark, sf):
    return nearest_neighbours(labelled_vectors(spark, sf), 5, "vec_id", "v", within="y").select("vec_id", "neighbour", "rank")


@query("smote", f"WITH {CLASSES}, c AS (SELECT y, count(*) AS n FROM lv GROUP BY 1) SELECT y, (SELECT max(n) FROM c) - n AS added, (SELECT max(n) FROM c) AS n FROM c")
def _smote(spark, sf):
    out = resampling.smote(labelled_vectors(spark, sf), "y", "vec_id", "v")
    return out.groupBy("y").agg(F.count_if("synthetic").alias("added"), F.count(F.lit(1)).alias("n"))


@query("edited_neighbours", f"""WITH {CLASSES}, d AS (SELECT a.vec_id, a.y, b.y AS other_y, row_number() OVER (PARTITION BY a.vec_id
  ORDER BY list_distance(a.v::DOUBLE[], b.v::DOUBLE[]), b.vec_id) AS rank FROM lv a JOIN lv b ON a.vec_id <> b.vec_id)
SELECT vec_id, y FROM d WHERE rank <= 3 GROUP BY ALL HAVING bool_and(y = other_y)""")
def _edited_neighbours(spark, sf):
    return resampling.edited_neighbours(labelled_vectors(spark, sf), "y", "vec_id", "v").select("vec_id", "y")


@query("smote_enn")
def _smote_enn(spark, sf):
    out = resampling.smote_enn(labelled_vectors(spark, sf), "y", "vec_id", "v")
    return out.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("added"))


def pipeline_rows(spark, sf):
    return encoders.booleans_to_int(wait_rows(spark, sf)).select(
        "timestamp", "callsign", "runway", "holding_point", "takeoff_time", "last_min_takeoffs",
        "time_since_last_event_seconds", "hour", "is_holiday")


NUMERIC = ["last_min_takeoffs", "time_since_last_event_seconds", "hour"]


@query("feature_vectors_standard", f"""WITH {WAITS}, n AS (SELECT epoch_us(timestamp) AS timestamp, callsign, runway, (last_min_takeoffs - avg(last_min_takeoffs) OVER ()) / stddev_samp(last_min_takeoffs) OVER () AS a,
  (hour - avg(hour) OVER ()) / stddev_samp(hour) OVER () AS b, CAST(is_holiday AS INTEGER) AS h FROM wr)
SELECT timestamp, callsign, round(a, 5) AS a, round(b, 5) AS b, CASE WHEN runway = 'A' THEN 1e0 ELSE 0e0 END AS is_a, CAST(h AS DOUBLE) AS holiday FROM n""")
def _feature_pipeline_lr(spark, sf):
    rows = pipeline_rows(spark, sf)
    model = encoders.feature_pipeline_lr(["runway", "holding_point"], NUMERIC, ["is_holiday"]).fit(rows)
    out = encoders.features_to_array(model.transform(rows))
    v = F.col("features_array")
    return rounded(out.select(micros("timestamp"), "callsign", v[0].alias("a"), v[2].alias("b"), v[3].alias("is_a"),
                              v[F.size(v) - 1].alias("holiday")), "a", "b", digits=5)


@query("feature_vectors_minmax", f"""WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, callsign, round((dense_rank() OVER (ORDER BY runway) - 1) / 2, 5) AS runway,
  round((hour - min(hour) OVER ()) / (max(hour) OVER () - min(hour) OVER ()), 5) AS hour FROM wr""")
def _feature_pipeline_minmax(spark, sf):
    rows = pipeline_rows(spark, sf)
    path = scratch_path(spark, "encoder")
    encoders.save_pipeline(encoders.feature_pipeline_minmax(["runway"], NUMERIC, one_hot=False).fit(rows), path)
    out = encoders.features_to_array(encoders.load_pipeline(path).transform(rows))
    v = F.col("features_array")
    return rounded(out.select(micros("timestamp"), "callsign", v[0].alias("runway"), v[3].alias("hour")), "runway", "hour", digits=5)
