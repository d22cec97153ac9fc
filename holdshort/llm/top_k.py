"""Exact top-k by inner product, block at a time.

Candidates are packed into shards, and a shard into blocks: ranges of an order in which similar vectors stand together. A
block knows the least and largest value of each component, so the sum of the larger products with a query bounds every
score in it. A query visits the blocks of a shard in the order of their bounds, scores a block as a whole through its
matrix, and stops when the next bound is below its k-th best score; a bound that equals it is still visited, since ties
go to the smaller id. Queries that visit the same block are scored together. What a group of queries has found in one
shard goes with it to the next. Rows are told apart by a number, not by their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdshort.session import freeze

SHARD_ROWS = 1024
BLOCK_ROWS = 128
GROUP_ROWS = 256
#: Shards that one group of queries passes in one task.
SHARDS_PER_CHUNK = 64
#: Packed rows that a task holds at once.
PACKED_ROWS = 32
PACKED = "number bigint, size int, width int, rows binary, ids binary, vectors binary"
LEAST = np.iinfo(np.int64).min


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as a whole number; null for vectors with null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _pack(rows: DataFrame, per_row: int) -> DataFrame:
    """(row, id, vector) -> rows of up to `per_row` vectors of one length, similar ones next to each other; input partitions are
    packed on their own."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[int, int, list[int]]]] = {}

        def packed(width: int) -> pa.RecordBatch:
            nonlocal number
            found = held.pop(width)
            rows, ids = np.array([x[:2] for x in found], dtype=np.int64).T
            vectors = np.array([v for _, _, v in found], dtype=np.int64).reshape(len(found), width)
            order = similar_order(vectors.astype(np.float64))
            rows, ids, vectors = rows[order], ids[order], vectors[order]
            number += 1
            return pa.RecordBatch.from_pydict({
                "number": pa.array([number]), "size": pa.array([len(ids)], pa.int32()), "width": pa.array([width], pa.int32()),
                "rows": pa.array([rows.tobytes()]), "ids": pa.array([ids.tobytes()]), "vectors": pa.array([vectors.tobytes()])})

        for batch in batches:
            for row, key, vector in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                held.setdefault(len(vector), []).append((row, key, vector))
                if len(held[len(vector)]) >= per_row:
                    yield packed(len(vector))
        for width in list(held):
            yield packed(width)

    return rows.mapInArrow(pack, PACKED)


def similar_order(vectors: np.ndarray) -> np.ndarray:
    """An order in which vectors on the same side of the leading principal directions stand together."""
    if not vectors.size:
        return np.arange(len(vectors))
    centred = vectors - vectors.mean(0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    sides = (centred @ directions[:, ::-1][:, :8] > 0).astype(np.int64)
    return np.lexsort((np.arange(len(vectors)), sides @ (1 << np.arange(sides.shape[1])[::-1])))


class Shard:
    """Vectors of one shard, cut into blocks in their order, with the ends of each component in each block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids = rows, ids
        # doubles hold sums of products exactly up to 2^53, whole numbers beyond that go without them
        most = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        self.exact_as_double = most < 1 << 23 and vectors.shape[1] <= 64 or most < 1 << 16 and vectors.shape[1] <= 1 << 20
        self.vectors = vectors.astype(np.float64) if self.exact_as_double else vectors
        starts = np.arange(0, len(ids), BLOCK_ROWS)
        self.blocks = [slice(s, s + BLOCK_ROWS) for s in starts]
        self.low = np.minimum.reduceat(vectors, starts, axis=0)
        self.high = np.maximum.reduceat(vectors, starts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Queries x blocks: no score in the block is higher."""
        positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
        if self.exact_as_double and np.abs(queries).max(initial=0) < 1 << 23:
            found = positive.astype(np.float64) @ self.high.T.astype(np.float64) + negative.astype(np.float64) @ self.low.T.astype(np.float64)
            return found.astype(np.int64)
        # in longer numbers a double is only a near bound: leave no block out
        return np.full((len(queries), len(self.blocks)), np.iinfo(np.int64).max)

    def scores(self, queries: np.ndarray, block: slice) -> np.ndarray:
        if self.exact_as_double and np.abs(queries).max(initial=0) < 1 << 23:
            return (queries.astype(np.float64) @ self.vectors[block].T).astype(np.int64)
        return queries @ self.vectors[block].astype(np.int64).T


class Best:
    """The best k (score, id) of each query of a group so far, and how many blocks its queries scored of all they met."""

    def __init__(self, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.own, self.ids, self.vectors, self.k = own, ids, vectors, k
        self.scored = self.met = 0
        self.rows, self.scores, self.found = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.kth = np.full(len(ids), LEAST)

    def add(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        rows, scores, found = (np.concatenate(x) for x in ((self.rows, rows), (self.scores, scores), (self.found, found)))
        order = np.lexsort((found, -scores, rows))
        rows, scores, found = rows[order], scores[order], found[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < self.k
        self.rows, self.scores, self.found = rows[keep], scores[keep], found[keep]
        full = rank == self.k - 1
        self.kth[rows[full]] = scores[full]

    def visit(self, shard: Shard) -> None:
        bounds = shard.bounds(self.vectors)
        order = np.argsort(-bounds, axis=1, kind="stable")
        self.met += bounds.size
        for turn in range(len(shard.blocks)):
            block_of = order[:, turn]
            active = np.flatnonzero(bounds[np.arange(len(block_of)), block_of] >= self.kth)
            if not len(active):
                break
            self.scored += len(active)
            for b in np.unique(block_of[active]):
                here = active[block_of[active] == b]
                ids = shard.ids[shard.blocks[b]]
                scores = shard.scores(self.vectors[here], shard.blocks[b])
                other = shard.rows[shard.blocks[b]][None, :] != self.own[here][:, None]
                enough = scores >= self.kth[here][:, None]
                if scores.shape[1] > self.k + 1:  # own row aside, k better ones in this block alone rule a score out
                    enough &= scores >= np.partition(scores, -self.k - 1, axis=1)[:, [-self.k - 1]]
                at, column = np.nonzero(other & enough)
                if len(at):
                    self.add(here[at], scores[at, column], ids[column])


def _searched(rows: DataFrame, is_query: Column, k: int, key: str, vector: str) -> DataFrame:
    """(query_row, query_id, found, score): the best k of each query in each chunk of shards. A row without query_row counts
    the blocks that a group of queries scored (found) of those it met (score)."""
    spark = rows.sparkSession
    valid = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    # numbers stay as they are once they are written
    single = freeze(valid.select(F.monotonically_increasing_id().alias("_row"), F.col(key), F.col(vector).alias("_vector")))
    queries = single.where(is_query)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    n_queries = queries.count()
    shards = freeze(_pack(single, SHARD_ROWS))
    n_shards = shards.count()
    # a small table has no more chunks than there are cores, so that all of them search
    chunks = max(1, -(-n_shards // SHARDS_PER_CHUNK), min(n_shards, spark.sparkContext.defaultParallelism))
    groups = _pack(queries.repartition(max(1, n_queries // (4 * GROUP_ROWS)), "_row"), GROUP_ROWS)
    dealt = shards.withColumn("chunk", F.pmod(F.xxhash64("number"), F.lit(chunks)))
    repeated = groups.select(*[F.col(c).alias(f"q_{c}") for c in groups.columns],
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, current = None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "query_row": pa.array([*best.own[best.rows].tolist(), None], pa.int64()),
                "query_id": pa.array([*best.ids[best.rows].tolist(), None], pa.int64()),
                "found": np.append(best.found, best.scored), "score": np.append(best.scores, best.met)})

        def numbers(data: bytes) -> np.ndarray:
            return np.frombuffer(data, dtype=np.int64)

        for whole in batches:
            for row in whole.to_pylist():
                if current != (row["chunk"], row["q_number"]):
                    if best is not None:
                        yield result()
                    current = row["chunk"], row["q_number"]
                    best = Best(numbers(row["q_rows"]), numbers(row["q_ids"]),
                                numbers(row["q_vectors"]).reshape(row["q_size"], row["q_width"]), k)
                best.visit(Shard(numbers(row["rows"]), numbers(row["ids"]), numbers(row["vectors"]).reshape(row["size"], row["width"])))
        if best is not None:
            yield result()

    # a merge join hands on all shards of a group one after another
    pairs = repeated.join(dealt.hint("merge"), (repeated["chunk"] == dealt["chunk"]) & (F.col("q_width") == F.col("width")))
    try:
        spark.conf.set(batch, str(PACKED_ROWS))
        return freeze(pairs.drop(dealt["chunk"]).mapInArrow(search, "query_row bigint, query_id bigint, found bigint, score bigint"))
    finally:
        spark.conf.set(batch, before)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank (from 1), the key of the found row and its score, for each query the k highest inner products.

    `vector` is an array of whole numbers; `is_query` is a condition on the key. Ties go to the smaller key. Rows with a
    null key or vector take no part. Rows that share a key are rows of their own: each is a candidate, also for the others,
    and if the key is a query's, each is a query, so that a rank comes once per row. Vectors are compared with those of
    their own length only. Scores must fit a long. A query with fewer than k candidates has fewer rows; an empty table
    gives none.

    Both sides are packed into rows of bounded size. Query groups are repeated for every chunk of shards and joined on
    the chunk, so no task sees more than a chunk and a group at once, and each shard is shuffled once.
    """
    found = _searched(rows, is_query, k, key, vector).where("query_row IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "found"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("found").alias(key), "score")


def blocks_scored(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(scored, met): pairs of a query and a block whose rows the search of `top_k` multiplied, of all such pairs."""
    counts = _searched(rows, is_query, k, key, vector).where("query_row IS NULL")
    return counts.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("scored"), F.coalesce(F.sum("score"), F.lit(0)).alias("met"))
