"""Forests and boosted trees fitted from histograms of bins (`models/histograms.py`), as Spark's own models.

A pass over the blocks adds, for the nodes that are to be split, weights and weighted targets per code; the bins of the
features that a node may split on come from these sums, which meet per tree. A forest takes a pass per level and batch of
trees whose sums fit `BUDGET`. Boosted trees of at most three levels take one pass: their nodes hold conditions on at
most two codes, so sums by three codes at a time give all levels.

The impurity of leaves at the full depth, and of nodes of trees grown in one pass, is not computed (NaN); predictions and
importances do not use it.
"""

from __future__ import annotations

import json
import math
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor

from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from holdshort.models import histograms as hist
from holdshort.session import remove, scratch_path

#: Bytes of the sums that a task holds.
BUDGET = 200 * 2**20
#: Sums by three codes at most.
CELLS = 2**20
#: Rounds of boosting until residuals are written anew.
ROUNDS = 8


class Grower:
    """Fits trees on the blocks of a table."""

    def __init__(self, estimator, rows, bootstrap: bool):
        get = estimator.getOrDefault
        self.spark, self.context = rows.sparkSession, rows.sparkSession.sparkContext
        self.rate, self.replace, self.seed = get("subsamplingRate"), bootstrap, get("seed")
        self.depth, self.least, self.gain = get("maxDepth"), get("minInstancesPerNode"), get("minInfoGain")
        self.rows = rows
        plain = rows.select(vector_to_array(get("featuresCol")).alias("x"), rows[get("labelCol")].cast("double").alias("y"))
        n = plain.count()
        if not n:
            raise ValueError("no rows to fit trees on")
        share = max(get("maxBins") ** 2, 10_000) / n
        sample = plain if share >= 1 else plain.sample(share, self.seed)
        found = [r.x for r in sample.select("x").where("x IS NOT NULL").collect()]
        categories = _categories(rows.schema[get("featuresCol")])
        self.layout = hist.layout(np.array(found, float).reshape(len(found), -1), categories, min(get("maxBins"), n))
        packed = self._store(plain.mapInArrow(hist.pack(self.layout), hist.BLOCKS))
        seen = [set() for _ in self.layout.groups]
        for part in self._read(packed).mapPartitions(hist.seen(len(seen))).collect():
            for a, b in zip(seen, part):
                a |= b
        self.layout.observe(seen)
        self.kind = "uint8" if max(self.layout.widths, default=0) <= 256 else "uint16" if max(self.layout.widths) <= 65536 else "int32"
        self.path = self._store(self.spark.read.parquet(packed).mapInArrow(hist.recode(self.layout, self.kind), hist.BLOCKS))
        remove(self.spark, packed)
        self.features = len(self.layout.cuts)

    def _store(self, blocks) -> str:
        path = scratch_path(self.spark, "blocks")
        blocks.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
        return path

    def _read(self, path: str):
        """Blocks one by one; sums of some tasks for each core meet, however many files there are."""
        rows = self.spark.read.schema(hist.BLOCKS).parquet(path).rdd
        return rows.coalesce(2 * self.context.defaultParallelism)

    def job(self, shifts=(), factor: float = 1.0) -> hist.Job:
        return hist.Job(self.layout, self.kind, self.seed, self.rate, self.replace, list(shifts), factor)

    def close(self) -> None:
        remove(self.spark, self.path)

    def _choice(self, tree: int, level: int, nodes: int, strategy: str, trees: int) -> np.ndarray:
        """Features by node."""
        count = features_per_node(strategy, self.features, trees)
        if count >= self.features:
            return np.ones((nodes, self.features), bool)
        draws = np.random.Generator(np.random.PCG64([self.seed & (2**64 - 1), tree, level])).random((nodes, self.features))
        return draws.argsort(1).argsort(1) < count

    def grow(self, job: hist.Job, numbers: list[int], strategy: str, trees: int) -> list[hist.Node]:
        """Trees of these numbers, level by level."""
        roots = [hist.Node(0) for _ in numbers]
        open_nodes = [[r] for r in roots]
        for level in range(self.depth):
            units = []
            most = max(1, BUDGET // (16 * sum(self.layout.widths)))
            for i, nodes in enumerate(open_nodes):
                chosen = self._choice(numbers[i], level, len(nodes), strategy, trees)
                units += [(i, nodes[k:k + most], chosen[k:k + most]) for k in range(0, len(nodes), most)]
            following = [[] for _ in roots]
            while units:
                batch, size = [], 0
                while units and (not batch or size + len(units[0][1]) <= most):
                    size += len(units[0][1])
                    batch.append(units.pop(0))
                for (i, nodes, _), (best, totals) in zip(batch, self._pass(job, [(numbers[i], roots[i], n, c) for i, n, c in batch])):
                    for node, found, n, s, q in zip(nodes, best, *totals):
                        node.n, node.s, node.q = float(n), float(s), float(q)
                        if found:
                            following[i] += hist.split(node, found)
            open_nodes = following
            if not any(open_nodes):
                break
        if not self.depth:
            for (best, totals), root in zip(self._pass(job, [(t, r, [r], np.zeros((1, self.features), bool)) for t, r in zip(numbers, roots)]), roots):
                root.n, root.s, root.q = map(float, totals[:, 0])
        return roots

    def _pass(self, job: hist.Job, batch: list) -> list:
        """Best splits and totals of the nodes of each (tree, root, nodes, features)."""
        layout, least, gain = self.layout, self.least, self.gain
        shared = self.context.broadcast((job, [(t, hist.router(layout, root, nodes), len(nodes), chosen) for t, root, nodes, chosen in batch]))

        def best(pair):
            i, (weights, targets, totals) = pair
            features = shared.value[1][i][3]
            mask = np.repeat(features[:, layout.order], [layout.arity[f] for f in layout.order], axis=1)
            whole = np.zeros((2, *mask.shape))
            whole[0][mask], whole[1][mask] = weights, targets
            return i, (hist.best_splits(layout, *whole, features, totals, least, gain), totals)

        sums = self._read(self.path).mapPartitions(hist.level(shared)).reduceByKey(
            lambda a, b: tuple(x + y for x, y in zip(a, b)), min(len(batch), 2 * self.context.defaultParallelism))
        found = dict(sums.map(best).collect())
        shared.destroy()
        return [found[i] for i in range(len(batch))]

    def boost(self, rounds: int, step: float, strategy: str) -> list[tuple[float, hist.Node]]:
        """Trees with their weights: the first on the targets, each further one on twice what the earlier ones leave."""
        out, shifts = [], []
        threes = list(combinations(range(len(self.layout.groups)), min(3, len(self.layout.groups))))
        joint = self.depth <= 3 and not self.replace and sum(math.prod(self.layout.widths[g] for g in t) for t in threes) <= CELLS
        for i in range(rounds):
            if len(shifts) >= ROUNDS:
                self._rewrite(shifts)
                shifts = []
            job = self.job(shifts, 2.0 if i else 1.0)
            tree = self._grow_joint(job, i, threes, strategy) if joint else self.grow(job, [i], strategy, 1)[0]
            weight = step if i else 1.0
            out.append((weight, tree))
            leaves = hist.leaves(tree)
            shifts.append((hist.router(self.layout, tree, leaves), weight * np.array([leaf.value for leaf in leaves] + [0.0])))
        return out

    def _rewrite(self, shifts: list) -> None:
        job = self.job(shifts)

        def run(batches):
            for batch in batches:
                for block, codes, y in zip(*[batch.column(c) for c in ("block", "codes", "y")]):
                    numbers = list(np.frombuffer(codes.as_buffer(), job.kind).reshape(len(job.layout.groups), -1).astype(np.intp))
                    left = job.target(numbers, np.frombuffer(y.as_buffer()))
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int64()), pa.array([codes.as_py()], pa.binary()),
                                                      pa.array([left.tobytes()], pa.binary())], ["block", "codes", "y"])

        old, self.path = self.path, self._store(self.spark.read.schema(hist.BLOCKS).parquet(self.path).mapInArrow(run, hist.BLOCKS))
        remove(self.spark, old)

    def _grow_joint(self, job: hist.Job, number: int, threes: list, strategy: str) -> hist.Node:
        layout, widths = self.layout, self.layout.widths
        shared = self.context.broadcast((job, number, threes))
        add = lambda a, b: [x + y for x, y in zip(a, b)]
        sums = self._read(self.path).mapPartitions(hist.triples(shared)).treeReduce(add, 2)
        shared.destroy()
        cells = {three: s.reshape(2, *[widths[g] for g in three]) for three, s in zip(threes, sums)}

        def bins(allowed: dict) -> np.ndarray:
            out = []
            for g in range(len(widths)):
                three = next(t for t in threes if {g, *allowed} <= set(t))
                part, kept = cells[three], 1
                for e in three:
                    here = allowed.get(e, np.ones(widths[e], bool))
                    if e == g:
                        part, kept = np.moveaxis(np.moveaxis(part, kept, -1) * here, -1, kept), 2
                    else:
                        part = np.tensordot(part, here.astype(float), (kept, 0))
                out.append(part @ layout.spread[g])
            return np.concatenate(out, 1)

        first = cells[threes[0]].reshape(2, -1).sum(1)
        root = hist.Node(0, float(first[0]), float(first[1]))
        nodes = [(root, {})]
        home = {f: (g, sum(layout.arity[e] for e in group[:k])) for g, group in enumerate(layout.groups) for k, f in enumerate(group)}
        for level in range(self.depth):
            chosen, following = self._choice(number, level, len(nodes), strategy, 1), []
            for (node, allowed), features in zip(nodes, chosen):
                weights, targets = bins(allowed)
                found = hist.best_splits(layout, weights[None], targets[None], features[None], np.array([[node.n], [node.s], [math.nan]]), self.least, self.gain)[0]
                if found:
                    left, right = hist.split(node, found)
                    g, at = home[node.feature]
                    goes = layout.spread[g][:, at:at + layout.arity[node.feature]] @ node.left_bins > 0
                    before = allowed.get(g, np.ones(widths[g], bool))
                    following += [(left, {**allowed, g: before & goes}), (right, {**allowed, g: before & ~goes})]
            nodes = following
        return root


def features_per_node(strategy: str, features: int, trees: int) -> int:
    """As Spark counts them for regression."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
             "log2": max(1, math.ceil(math.log2(features))) if features else 0}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def _categories(column) -> dict[int, int]:
    """Feature -> number of categories, from the metadata of a vector column."""
    groups = (column.metadata or {}).get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: 2 for a in groups.get("binary", []) if "idx" in a}
    for a in groups.get("nominal", []):
        count = a.get("numVals") or len(a.get("vals", []))
        if count and "idx" in a:
            out[a["idx"]] = count
    return out


SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                  ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", SPLIT)])


class _Scored:
    """Spark's model with predictions in numpy: all rows of a batch go down a tree together."""

    def _transform(self, dataset):
        out = self.getPredictionCol()
        if self.getLeafCol() or not out:
            return super()._transform(dataset)
        return dataset.withColumn(out, F.coalesce(self._predictor(vector_to_array(dataset[self.getFeaturesCol()])), F.lit(math.nan)))


def _model(estimator, kind, layout: hist.Layout, trees: list[tuple[float, hist.Node]], spark):
    """Spark's model of these trees, read back from its own file format."""
    forest = issubclass(kind, RandomForestRegressionModel)
    params = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items() if estimator.hasParam(p.name)}
    head = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    tree_params = ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed")
    tree_head = {**head, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "defaultParamMap": {},
                 "paramMap": {k: estimator.getOrDefault(k) for k in tree_params}}
    path = scratch_path(spark, "trees")
    meta = {**head, "class": f"org.apache.spark.ml.regression.{kind.spark_model.__name__}", "uid": estimator.uid, "paramMap": params,
            "defaultParamMap": defaults, "numFeatures": len(layout.cuts), "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    heads = [(i, json.dumps({**tree_head, "uid": f"dtr_{estimator.uid}_{i}"}), 1.0 if forest else float(w)) for i, (w, _) in enumerate(trees)]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    flat = [(i, n) for i, (_, root) in enumerate(trees) for n in hist.flat(layout, root)]
    nodes = pa.table({"treeID": pa.array([i for i, _ in flat], pa.int32()), "nodeData": pa.array([n for _, n in flat], NODE)})
    spark.createDataFrame(nodes).write.parquet(f"{path}/data")
    model = kind.spark_model.load(path)
    model.__class__ = kind  # a second wrapper would release the model in the JVM with the first
    remove(spark, path)
    model._predictor = _predictor(layout, trees)
    return estimator._copyValues(model)


def _predictor(layout: hist.Layout, trees: list[tuple[float, hist.Node]]):
    """Arrow function from arrays of features to the sum, or for a forest the mean, of the trees' predictions."""
    forest = hist.Forest(layout, trees)

    @arrow_udf("double")
    def predict(x: pa.Array) -> pa.Array:
        return pa.array(forest.predict(hist.vectors(x)))
    return predict


def _plain(estimator, rows) -> bool:
    """Whether the fit is one of those made here; what else Spark's estimators offer is left to them."""
    get = lambda name: estimator.getOrDefault(name) if estimator.hasParam(name) and estimator.hasDefault(name) else None
    if any(estimator.isSet(p) for p in ("weightCol", "validationIndicatorCol") if estimator.hasParam(p)):
        return False
    if get("minWeightFractionPerNode") or get("lossType") not in (None, "squared"):
        return False
    sizes = _categories(rows.schema[estimator.getFeaturesCol()]).values()
    return max(sizes, default=0) <= estimator.getMaxBins()


class HistogramForestModel(_Scored, RandomForestRegressionModel):
    spark_model = RandomForestRegressionModel


class HistogramBoostingModel(_Scored, GBTRegressionModel):
    spark_model = GBTRegressionModel


class HistogramForest(RandomForestRegressor):
    """Spark's random forest for regression, fitted from histograms."""

    def _fit(self, dataset):
        if not _plain(self, dataset):
            return super()._fit(dataset)
        grower = Grower(self, dataset, self.getBootstrap())
        count = self.getNumTrees()
        roots = grower.grow(grower.job(), list(range(count)), self.getFeatureSubsetStrategy(), count)
        grower.close()
        return _model(self, HistogramForestModel, grower.layout, [(1 / count, r) for r in roots], dataset.sparkSession)


class HistogramBoosting(GBTRegressor):
    """Spark's gradient-boosted trees for squared loss, fitted from histograms."""

    def _fit(self, dataset):
        if not _plain(self, dataset):
            return super()._fit(dataset)
        grower = Grower(self, dataset, False)
        trees = grower.boost(self.getMaxIter(), self.getStepSize(), self.getFeatureSubsetStrategy())
        grower.close()
        return _model(self, HistogramBoostingModel, grower.layout, trees, dataset.sparkSession)
