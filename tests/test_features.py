import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdshort.features import encoders, resampling, splits
from holdshort.features.neighbours import nearest_neighbours
from holdshort.models import regression, search
from holdshort.operators import cleaning, reports, statistics


def brute_neighbours(points, k, labels=None):
    out = {}
    for i, p in points.items():
        d = sorted((round(float(np.linalg.norm(np.array(p) - np.array(q))), 6), j) for j, q in points.items()
                   if j != i and (labels is None or labels[i] == labels[j]))
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("pivots,chunk", [(1, 1000), (12, 1000), (9, 10)])
def test_neighbours_equal_brute_force_with_copies(spark, pivots, chunk):
    rnd = random.Random(5)
    points = {i: [float(rnd.randrange(12)), float(rnd.randrange(12))] for i in range(120)}
    points |= {i: [3.0, 3.0] for i in range(120, 180)}  # a third are copies
    labels = {i: i % 3 for i in points}
    df = spark.createDataFrame([(i, labels[i], p) for i, p in points.items()], "i long, y int, v array<double>")
    for within in (None, "y"):
        found = {}
        for r in nearest_neighbours(df, 4, "i", "v", within, pivots=pivots, chunk=chunk).orderBy("rank").collect():
            found.setdefault(r.i, []).append(r.neighbour)
        assert found == brute_neighbours(points, 4, labels if within else None)


def test_neighbour_search_hands_on_bounded_pieces():
    """Random vectors rule no cell out: each asks every cell, which must not be one table of all vectors times all cells."""
    import tracemalloc

    import pyarrow as pa

    from holdshort.features import neighbours

    rnd = np.random.default_rng(4)
    a, centres = rnd.normal(size=(2000, 64)), rnd.normal(size=(200, 64))
    vec = lambda x: pa.array(list(x))
    batch = pa.RecordBatch.from_pydict({"vid": np.arange(2000), "vec": vec(a), "grp": [""] * 2000, "cell": pa.array(np.zeros(2000), pa.int32()),
                                        "limit": pa.nulls(2000, pa.float64())})
    tracemalloc.start()
    asked = 0
    for out in neighbours._asking({"": (np.arange(200), np.full(200, 9.0))}, centres)([batch]):
        assert out.num_rows <= 2000 and "vec" not in out.schema.names
        asked += out.num_rows
    assert asked == 2000 * 199

    rows = pa.table({"vid_row": np.arange(5000), "vec_row": vec(rnd.normal(size=(5000, 64)) + 1e5)})
    base = pa.table({"vid": np.arange(2000), "vec": vec(a + 1e5), "limit": pa.nulls(2000, pa.float64())})
    found = neighbours._compare(3)(base, rows)
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()
    x, y = (neighbours._matrix(t) for t in (base["vec"], rows["vec_row"]))
    d = np.stack([np.sqrt(((y - p) ** 2).sum(1)) for p in x[:50]])
    assert found["near"].to_numpy()[:150].reshape(50, 3).tolist() == np.argsort(d, axis=1, kind="stable")[:, :3].tolist()


@pytest.mark.parametrize("name", ["edited", "smote", "both"])
def test_resampling_with_more_vectors_than_a_chunk(spark, monkeypatch, name):
    from holdshort.features import neighbours

    monkeypatch.setattr(neighbours, "CHUNK_BYTES", 0)  # chunks of 256
    rnd = np.random.default_rng(6)
    points = {i: [float(x) for x in rnd.normal(size=8)] for i in range(700)}
    df = spark.createDataFrame([(i, int(i % 5 == 0), p) for i, p in points.items()], "i long, y int, v array<double>")
    if name == "edited":
        near = brute_neighbours(points, 3)
        assert {r.i for r in resampling.edited_neighbours(df, "y", "i", "v").collect()} == {
            i for i in points if all(j % 5 == 0 for j in near[i]) == (i % 5 == 0) == any(j % 5 == 0 for j in near[i])}
    elif name == "smote":
        made = resampling.smote(df, "y", "i", "v").where("synthetic").collect()
        assert len(made) == 420 and all(r.y == 1 for r in made)
    else:
        assert 0 < resampling.smote_enn(df, "y", "i", "v").count() < 1120


def test_smote_fills_classes_between_neighbours(spark):
    rows = [(i, 0, [float(i), 0.0]) for i in range(20)] + [(100 + i, 1, [50.0 + i, 1.0]) for i in range(5)] + [(200, 2, [9.0, 9.0])]
    out = resampling.smote(spark.createDataFrame(rows, "i long, y int, v array<double>"), "y", "i", "v", k=2).collect()
    assert {y: sum(r.y == y for r in out) for y in (0, 1, 2)} == {0: 20, 1: 20, 2: 1}
    made = [r for r in out if r.synthetic]
    assert all(50 <= r.v[0] <= 54 and r.v[1] == 1.0 and r.i < 0 for r in made) and len({r.i for r in made}) == 15


def test_oversample_sizes_and_untouched(spark):
    rows = spark.createDataFrame([(i, "a") for i in range(10)] + [(i, "b") for i in range(3)] + [(i, "c") for i in range(30)], "i long, y string")
    out = resampling.oversample_to_class(rows, "y", "a", ["c"]).collect()
    assert {y: sum(r.y == y for r in out) for y in "abc"} == {"a": 10, "b": 10, "c": 30}
    assert {r.i for r in out if r.y == "b"} <= {0, 1, 2}


def test_bounds_remove_whole_flights(table):
    rows = table([("A", 0.0, 5.0), ("A", 10.0, 100.0), ("A", 90_000.0, 100.0), ("B", 0.0, 100.0)], "callsign string, timestamp ts, w double")
    left = cleaning.drop_out_of_bounds_flights(rows, "w", 20, 1250)
    assert left.count() == 2
    report = cleaning.bounds_report(rows, "w", 20, 1250).first()
    assert (report.removed_rows, report.removed_flights) == (2, 1)


def test_cast_schema_gives_null_for_misfits(spark):
    df = spark.createDataFrame([("12", "x", "k")], "`Downlink Format` string, Speed string, other string")
    row = cleaning.cast_schema(df).first()
    assert (row["Downlink Format"], row["Speed"], row["other"]) == (12, None, "k")


def test_fold_days_are_complete(table):
    rows = table([(1733011199.0,), (1733097599.0,), (1733615999.0,)], "timestamp ts")  # 30 Nov, 1 Dec, 7 Dec 2024, last seconds
    train, val = splits.expanding_folds(rows)[0]
    assert (train.count(), val.count()) == (1, 2)


def test_rank_blocks(spark):
    blocks = {r.id: r.block for r in splits.with_rank_block(spark.range(13), ["id"], 5).collect()}
    assert [blocks[i] for i in range(13)] == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_one_vocabulary_for_train_and_test(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("z",), ("a",)], "c string")
    words = {"c": encoders.vocabulary(train, "c")}
    assert encoders.one_hot_wide(train, ["c"], words).columns == encoders.one_hot_wide(test, ["c"], words).columns
    assert sorted(map(tuple, encoders.one_hot_wide(test, ["c"], words).collect())) == [(0, 0), (1, 0)]


def test_categories_of_any_number(spark):
    rows = spark.range(1500).select(F.format_string("v%04d", "id").alias("c"), F.col("id").alias("k"))
    assert encoders.vocabulary(rows, "c") == [f"v{i:04d}" for i in range(1500)]
    more = rows.unionByName(spark.createDataFrame([("new", -1), (None, -2)], "c string, k bigint"))
    coded = {r.k: r.c for r in encoders.one_hot_sparse(more, "c", encoders.label_codes(rows, "c")).collect()}
    assert all(coded[i].size == 1500 and coded[i].indices == [i] and coded[i].values == [1.0] for i in range(1500))
    assert coded[-1].indices == coded[-2].indices == []


def test_frequent_values_do_not_shift_quantiles(spark):
    values = [1.0] * 900 + [float(i) for i in range(100)]
    rows = spark.createDataFrame([("a", v) for v in values] + [(None, v * 2) for v in values], "g string, v double")
    probs = [0.0, 0.05, 0.5, 0.95, 0.999, 1.0]
    got = {(r.g, r.prob): r.value for r in statistics.exact_quantiles(rows, "v", probs, ["g"]).collect()}
    alone = {r.prob: r.value for r in statistics.exact_quantiles(rows.where("g = 'a'"), "v", probs).collect()}
    for p in probs:
        want = float(np.quantile(values, p))
        assert abs(got["a", p] - want) < 1e-9 and abs(got[None, p] - 2 * want) < 1e-9 and abs(alone[p] - want) < 1e-9


def test_neighbours_far_from_the_origin_and_odd_rows(spark):
    rows = [(i, [1e6 + 0.001 * i * i, 1e6], "x" if i % 2 else None) for i in range(12)] + [(50, None, "x"), (51, [None, 1.0], "x")]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, label string")
    got = {r.id: r.neighbour for r in nearest_neighbours(df, 1, "id", "v").collect()}
    assert got == {i: max(0, i - 1) if i else 1 for i in range(12)}
    within = {r.id: r.neighbour for r in nearest_neighbours(df, 1, "id", "v", within="label").collect()}
    assert within == {i: i - 2 if i > 1 else i + 2 for i in range(12)}


def test_class_shares_without_a_global_window(spark):
    rows = spark.createDataFrame([("a",)] * 9 + [("b",)], "label string")
    assert {r.label: r.share for r in statistics.class_distribution(rows, "label").collect()} == {"a": 0.9, "b": 0.1}
    assert {r.label: round(r.weight, 6) for r in statistics.class_weights(rows, "label").collect()} == {"a": round(10 / 18, 6), "b": 5.0}


def test_quantiles_of_small_groups(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 10)] + [("b", 5.0)], "g string, v double")
    got = {(r.g, r.prob): r.value for r in statistics.exact_quantiles(rows, "v", [0.25, 0.5, 1.0], ["g"]).collect()}
    assert got == {("a", 0.25): 1.75, ("a", 0.5): 2.5, ("a", 1.0): 10.0, ("b", 0.25): 5.0, ("b", 0.5): 5.0, ("b", 1.0): 5.0}


def test_report_has_one_line_for_all_rows(spark):
    rows = spark.createDataFrame([(0.0, 1.0, "r", None), (10.0, 8.0, "r", "h")], "takeoff_time double, prediction double, runway string, holding_point string")
    got = {(r.scope, r.key): r for r in reports.regression_report(rows).collect()}
    assert set(got) == {("all", None), ("runway", "r"), ("holding_point", "h")}
    assert got["all", None].mape == pytest.approx((100 + 20) / 2) and got["all", None].r2 == pytest.approx(0.9)


@pytest.fixture(scope="module")
def line(spark):
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    rows = rows.withColumns({"takeoff_time": 3 * F.col("x") + F.col("z"), "runway": F.when(F.col("z") > 3, "p").otherwise("q")})
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows)


def test_grid_search_prefers_the_better_setting(line):
    make = lambda **p: regression.linear_regression("takeoff_time", **p)
    best, results = search.grid_search(make, search.param_grid(regParam=[50.0, 0.001]), [(line, line)], "takeoff_time")
    assert best == {"regParam": 0.001} and results[1]["val_rmse"] < 0.1


def test_linear_grid_needs_no_fit_per_setting(line, monkeypatch):
    from pyspark.ml.regression import LinearRegression

    train, validation = line.where("x < 15"), line.where("x >= 12")
    grid = search.param_grid(regParam=[0.01, 1.0], elasticNetParam=[0.0, 0.5], maxIter=[50, 100])
    make = lambda **p: regression.linear_regression("takeoff_time", **p)
    want = []
    for p in grid[::2]:
        model = make(**p).fit(train)
        want.append([x for part in (train, validation) for x in search.regression_errors(model.transform(part), "takeoff_time")])

    def refuse(*_):
        raise AssertionError("a setting was fitted by itself")

    monkeypatch.setattr(LinearRegression, "fit", refuse)
    _, got = search.grid_search(make, grid, [(train, validation)], "takeoff_time")
    for p, errors in zip(grid[::2], want):
        row = next(r for r in got if r["params"] == p)
        assert [row[e] for e in ("train_mae", "train_rmse", "val_mae", "val_rmse")] == pytest.approx(errors, abs=1e-4)


def test_fits_read_even_pieces(spark):
    from holdshort.catalog import models
    from holdshort.operators.spread import even_pieces

    rows = even_pieces(spark.range(1000).coalesce(1), 100)
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 110
    assert models.encoded(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_tree_ensembles_fit_a_line(line):
    for scored in (
        regression.ada_boost(line, "takeoff_time", rounds=5, max_depth=5).transform(line),
        regression.two_regime_model(line, line, "takeoff_time", lambda: regression.boosted_trees("takeoff_time", maxIter=5)).both,
        regression.model_per_group(line, line, "runway", lambda: regression.boosted_trees("takeoff_time", maxIter=5), ["p", "q"]),
    ):
        mae, _ = search.regression_errors(scored, "takeoff_time")
        assert scored.count() == 400 and mae < 5


def test_training_does_not_see_test_rows(spark):
    from holdshort.plans import training

    rnd = random.Random(3)
    rows = [(f"2020-{1 + i % 10:02d}-{1 + i % 27:02d} 10:00:00", rnd.choice("ab"), float(i % 13), float(i % 13 * 3 + rnd.random())) for i in range(600)]
    df = spark.createDataFrame(rows, "t string, kind string, x double, y double").withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")
    folds = [("2020-04-30", "2020-05-01", "2020-05-31"), ("2020-06-30", "2020-07-01", "2020-07-31")]

    def run(table):
        return training.train(table, "2020-09-01", folds, encoders.feature_pipeline_lr(["kind"], ["x"]),
                              lambda **p: regression.linear_regression("y", **p), search.param_grid(regParam=[0.0, 50.0]), target="y")

    got = run(df)
    assert got.best == {"regParam": 0.0} and len(got.results) == 2
    weights = {r.feature: r.weight for r in got.importances().collect()}
    assert any(name.startswith("kind_ohe") for name in weights) and max(weights.values()) > 5
    changed = run(df.withColumn("x", F.when(F.col("timestamp") >= "2020-09-01", 1000.0).otherwise(F.col("x"))))
    assert (changed.model.coefficients.toArray() == got.model.coefficients.toArray()).all()
    forest = training.train(df, "2020-09-01", folds[:1], encoders.feature_pipeline_lr(["kind"], ["x"]),
                            lambda **p: regression.random_forest("y", numTrees=5, **p), [{"maxDepth": 3}], target="y")
    assert abs(sum(r.weight for r in forest.importances().collect()) - 1) < 1e-6


def test_neighbour_search_does_not_shuffle_a_vector_to_every_chunk(spark):
    """Random vectors rule no cell out; each used to be shuffled once for each chunk of all others."""
    from holdshort.features import neighbours

    rnd = np.random.default_rng(8)
    points = {i: [float(x) for x in rnd.normal(size=12)] for i in range(600)}
    df = spark.createDataFrame([(i, p) for i, p in points.items()], "i long, v array<double>")
    found = nearest_neighbours(df, 3, "i", "v", pivots=30, chunk=20)
    got = {}
    for r in found.orderBy("rank").collect():
        got.setdefault(r.i, []).append(r.neighbour)
    assert got == brute_neighbours(points, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and not hasattr(neighbours, "_blocks")
