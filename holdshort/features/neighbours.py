"""Exact nearest neighbours of dense vectors, split into blocks of bounded size.

Equal vectors are merged first: of a group of copies only the few smallest ids can be anybody's neighbours. Distinct
vectors are assigned to the nearest of a bounded number of pivots, so that a cell holds about a chunk of them. A vector is
compared with its own cell, and then only with cells that the triangle inequality does not rule out. Cells are cut into
chunks and compared chunk by chunk with numpy: a matrix product with a bound on its rounding errors rules pairs out, what
is left is measured from differences. Pairs of chunks are read from frozen tables and not shuffled; a vector hands on k
rows per `RIGHT` chunks at most, never all pairs.

Where the triangle inequality rules nothing out, as with many dimensions, the work is quadratic: every chunk meets every
other. A task still holds `RIGHT` chunks and, in Python, two of them and one slice of their products at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort.operators.spread import spread_join
from holdshort.session import freeze

MAX_PIVOTS = 2000
#: Vectors of a chunk at most, and bytes of its vectors.
CHUNK, CHUNK_BYTES = 8192, 2**23
#: Numbers of a slice of distances or products.
SLICE = 1_000_000
SALTS = 64
#: Chunks that a task holds to compare others with.
RIGHT = 16


def _copies(rows: DataFrame, keep: int) -> DataFrame:
    """(grp, vec, vid, ids): distinct vectors, their smallest id and their `keep` smallest ids, in two steps."""
    key = [F.xxhash64("vec").alias("_h"), "grp", "vec"]
    part = Window.partitionBy("_h", "grp", "vec", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy("id")
    some = rows.select(*key, "id").withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= keep)
    whole = Window.partitionBy("_h", "grp", "vec").orderBy("id")
    few = some.withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= keep)
    return few.groupBy("_h", "grp", "vec").agg(F.min("id").alias("vid"), F.array_sort(F.collect_list("id")).alias("ids")).drop("_h")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From differences, slice by slice: an expanded square would lose the digits of long vectors."""
    step = max(1, 4 * SLICE // max(1, b.size))
    return np.concatenate([np.sqrt(((a[i:i + step, None, :] - b[None]) ** 2).sum(2)) for i in range(0, max(1, len(a)), step)])


def _matrix(column) -> np.ndarray:
    """Rows of a column of lists, which have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    widths = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), widths[0] if widths else 0)


def _candidates(a: np.ndarray, b: np.ndarray, limit: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all pairs that can be among the `count` nearest of b and within the limit.

    Squared distances come from a matrix product of the vectors less a common centre. Its rounding errors are below
    `slack` times the sum of both squares; what is not a number counts as near.
    """
    centre = b.mean(0)
    a, b = a - centre, b - centre
    slack = 4 * (a.shape[1] + 8) * np.finfo(float).eps
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    product = a @ b.T
    bound = limit * limit * (1 + 1e-9)
    if len(b) > count and not np.isfinite(bound).all():
        kth = np.partition((1 + slack) / 2 * bb - product, count - 1, axis=1)[:, count - 1]
        bound = np.fmin(bound, 2 * kth + (1 + slack) * aa)
    product -= (1 - slack) / 2 * bb
    return np.nonzero(~(product < (((1 - slack) * aa - bound) / 2)[:, None]))


def _near(a: np.ndarray, b: np.ndarray, limit: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, distance) of the `count` nearest of b within the limit, ties by place."""
    found = []
    step = max(1, SLICE // len(b))
    for start in range(0, len(a), step):
        part, most = a[start:start + step], limit[start:start + step]
        with np.errstate(all="ignore"):
            i, j = _candidates(part, b, most, count)
            wide = max(1, SLICE // max(1, a.shape[1]))
            d = np.concatenate([np.sqrt(((part[i[k:k + wide]] - b[j[k:k + wide]]) ** 2).sum(1)) for k in range(0, max(1, len(i)), wide)])
        keep = ~(d > most[i])
        i, j, d = i[keep], j[keep], d[keep]
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < count
        found.append((i[first] + start, j[first], d[first]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _compare(count: int):
    """Block comparison: for each base vector the `count` nearest of the block, ties by id."""
    def run(base: pa.Table, rows: pa.Table) -> pa.Table:
        if not base.num_rows or not rows.num_rows:
            return pa.table({"vid": pa.array([], pa.int64()), "near": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
        rows = rows.sort_by("vid_row")
        limit = pc.fill_null(base["limit"], math.inf).to_numpy()
        i, j, d = _near(_matrix(base["vec"]), _matrix(rows["vec_row"]), limit, count)
        return pa.table({"vid": base["vid"].to_numpy()[i], "near": rows["vid_row"].to_numpy()[j], "dist": d})
    return run


def _lists(matrix: np.ndarray) -> pa.Array:
    """A column of lists from rows of a matrix."""
    offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1)))


def _chunk(rows: pa.Table) -> pa.Table:
    """The vectors of one (grp, cell, part) as one row."""
    rows = rows.sort_by("vid")
    return pa.table({"grp": rows["grp"][:1], "cell": rows["cell"][:1], "part": rows["part"][:1],
                     "vids": pa.array([rows["vid"].to_numpy().tobytes()], pa.binary()),
                     "vecs": pa.array([_matrix(rows["vec"]).tobytes()], pa.binary())})


CHUNKS = "grp string, cell int, part int, vids binary, vecs binary"
FOUND = "vid long, near long, dist double"


class _Left:
    """A chunk whose vectors look for neighbours, with the nearest that they have found and how far they still look."""

    def __init__(self, vids, vecs, limits, count: int):
        self.vids, self.count = np.frombuffer(vids, np.int64), count
        self.vecs = np.frombuffer(vecs).reshape(len(self.vids), -1)
        self.limits = np.full(len(self.vids), np.inf) if limits is None else np.frombuffer(limits).copy()
        self.found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def batch(self, grp: str, cell: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.vids), _lists(self.vecs), pa.array([grp] * len(self.vids), pa.string()),
             pa.array(self.limits), pa.array(np.full(len(self.vids), cell, np.int32))], ["vid", "vec", "grp", "limit", "cell"])

    def compare(self, vids, vecs, at: np.ndarray | None = None) -> None:
        """Look among the vectors of a chunk, for all or for the vectors at some places."""
        at = np.arange(len(self.vids)) if at is None else at
        vids = np.frombuffer(vids, np.int64)
        base = pa.table({"vid": at, "vec": _lists(self.vecs[at]), "limit": self.limits[at]})
        rows = pa.table({"vid_row": vids, "vec_row": _lists(np.frombuffer(vecs).reshape(len(vids), -1))})
        new = _compare(self.count)(base, rows)
        i, near, dist = (np.concatenate([old, new[c].to_numpy()]) for old, c in zip(self.found, ("vid", "near", "dist")))
        order = np.lexsort((near, dist, i))
        i, near, dist = i[order], near[order], dist[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        first, last = rank < self.count, rank == self.count - 1
        self.found = i[first], near[first], dist[first]
        self.limits[i[last]] = np.fmin(self.limits[i[last]], dist[last])

    def packed(self) -> tuple[bytes, bytes, bytes]:
        i, near, dist = self.found
        return self.vids[i].tobytes(), near.tobytes(), dist.tobytes()


def _own(count: int, cells: dict, centres: np.ndarray):
    """Chunks with what their vectors find in the chunk itself, and the other cells that any of them has to ask."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                left = _Left(row["vids"], row["vecs"], None, count)
                left.compare(row["vids"], row["vecs"])
                asks = sorted({b.column("cell")[0].as_py() for b in _asking(cells, centres)([left.batch(row["grp"], row["cell"])])})
                found = left.packed()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip((*row.values(), left.limits.tobytes(), asks, *found),
                                                     (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                                                      pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()))],
                    [*row, "limits", "asks", "vid", "near", "dist"])
    return run


def _others(count: int, cells: dict, centres: np.ndarray):
    """What each left chunk finds in the other chunks, of which one at a time is read; pairs of a chunk stand together."""
    def run(pairs):
        key, left = None, None
        for pair in pairs:
            if key != (pair.grp, pair.cell, pair.part):
                if left is not None:
                    yield left.packed()
                key, left = (pair.grp, pair.cell, pair.part), _Left(pair.vids, pair.vecs, pair.limits, count)
            if pair.cell_row == pair.cell:
                left.compare(pair.vids_row, pair.vecs_row)
                continue
            ids, radius = cells[pair.grp]
            one = ids == pair.cell_row
            for asking in _asking({pair.grp: (ids[one], radius[one])}, centres)([left.batch(pair.grp, pair.cell)]):
                left.compare(pair.vids_row, pair.vecs_row, np.searchsorted(left.vids, asking.column("vid").to_numpy()))
        if left is not None:
            yield left.packed()
    return run


def _unpack(batches):
    for batch in batches:
        for vid, near, dist in zip(*batch.columns):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), t)) for x, t in ((vid, np.int64), (near, np.int64), (dist, float))],
                                             ["vid", "near", "dist"])


def _top(found: DataFrame, count: int) -> DataFrame:
    w = Window.partitionBy("vid").orderBy("dist", "near")
    return found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= count).drop("_r")


def _asking(cells: dict, centres: np.ndarray):
    """The cells that each vector of a batch has to ask, without the vector; rows of one batch at most are made at once.

    `cells` has the numbers and radii of the cells of a group.
    """
    def run(batches):
        for batch in batches:
            groups = np.array(batch.column("grp").to_pylist(), dtype=object)
            for grp in dict.fromkeys(groups):
                part = batch.take(pa.array(np.flatnonzero(groups == grp)))
                ids, radius = cells[grp]
                gap = _distances(_matrix(part.column("vec")), centres[ids]) - radius[None, :]
                limit = pc.fill_null(part.column("limit"), math.inf).to_numpy()[:, None]
                hit = ~(gap > limit * (1 + 1e-9) + 1e-6) & (ids[None, :] != part.column("cell").to_numpy()[:, None])
                for k in np.flatnonzero(hit.any(0)):
                    out = part.take(pa.array(np.flatnonzero(hit[:, k]))).select(["vid", "grp", "limit"])
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.full(out.num_rows, ids[k]), pa.int32())],
                                                     [*out.schema.names, "cell"])
    return run


def nearest_neighbours(rows: DataFrame, k: int, id: str, vector: str, within: str | None = None,
                       pivots: int | None = None, chunk: int | None = None, seed: int = 22) -> DataFrame:
    """(id, neighbour, distance, rank): the k nearest other rows of each row, ties by id; `within` keeps to one label.

    `id` is a unique integer, `vector` an array of numbers. Rows with a null vector, or one with a null component, take no
    part; rows with a null label are a group of their own.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(within).cast("string")), F.lit("")) if within else F.lit("")
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
    plain = rows.where(whole).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), group.alias("grp"))
    count = k + 1
    distinct = freeze(_copies(plain, count))
    n, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    chunk = chunk or max(256, min(CHUNK, CHUNK_BYTES // (8 * max(1, width or 0))))
    wanted = pivots or max(1, min(MAX_PIVOTS, math.ceil(n / chunk)))
    chosen = distinct.orderBy(F.xxhash64(F.lit(seed), "vid")).limit(wanted).select("vec").collect()
    centres = np.array([r.vec for r in chosen], dtype=float)
    # a frozen table has few pieces for its bytes, but each of its rows is compared with many
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column("vec")), centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d.argmin(1), pa.int32()), pa.array(d.min(1))],
                                                 [*batch.schema.names, "cell", "far"])

    spread = distinct.where("vid IS NOT NULL").select("vid", "vec", "grp").repartition(parts, "vid")
    placed = freeze(spread.mapInArrow(assign, "vid long, vec array<double>, grp string, cell int, far double"))

    # at most labels x pivots rows
    reach = placed.groupBy("grp", "cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()
    cells = {}
    for r in reach:
        cells.setdefault(r.grp, []).append((r.cell, r.far))
    cells = {g: (np.array([c for c, _ in v]), np.array([f for _, f in v])) for g, v in cells.items()}

    # few vectors go into smaller chunks, so that there is work for all tasks
    context = rows.sparkSession.sparkContext
    size = min(chunk, max(256, math.ceil(n / (4 * context.defaultParallelism))))
    sizes = placed.groupBy("grp", "cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_parts"))
    parted = placed.join(sizes, ["grp", "cell"]).withColumn("part", F.pmod(F.xxhash64("vid"), F.col("_parts")).cast("int"))
    chunks = freeze(parted.select("grp", "cell", "part", "vid", "vec").groupBy("grp", "cell", "part").applyInArrow(_chunk, CHUNKS))
    count_of = sum(math.ceil(r.n / size) for r in reach)
    own = freeze(chunks.repartition(max(1, min(count_of, 2000))).mapInArrow(
        _own(count, cells, centres), f"{CHUNKS}, limits binary, asks array<int>, vid binary, near binary, dist binary"))

    # pairs of chunks are read from the frozen tables, not shuffled; a task holds the chunks of one right piece
    left = own.select("grp", "cell", "part", "vids", "vecs", "limits", "asks").coalesce(4 * context.defaultParallelism)
    right = chunks.select(*[F.col(c).alias(f"{c}_row") for c in chunks.columns]).repartition(max(1, math.ceil(count_of / RIGHT)))
    right = freeze(right)
    other_part = (F.col("cell") == F.col("cell_row")) & (F.col("part") != F.col("part_row"))
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("grp") == F.col("grp_row")) & (
        other_part | F.array_contains("asks", F.col("cell_row")))).drop("asks", "grp_row")
    found = rows.sparkSession.createDataFrame(pairs.rdd.mapPartitions(_others(count, cells, centres)), "vid binary, near binary, dist binary", verifySchema=False)
    near = _top(own.select("vid", "near", "dist").unionByName(found).mapInArrow(_unpack, FOUND), count)

    # back from distinct vectors to ids: at most count x count per vector
    copies = distinct.select(F.col("vid").alias("near"), F.explode("ids").alias("neighbour"))
    ranked = near.join(copies, "near").withColumn(
        "_r", F.row_number().over(Window.partitionBy("vid").orderBy("dist", "neighbour"))).where(F.col("_r") <= count)
    lists = ranked.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("_r", "neighbour", "dist"))).alias("_list"))
    back = plain.join(distinct.select("grp", "vec", "vid"), ["grp", "vec"]).select("id", "vid")
    back = spread_join(back, lists, ["vid"])
    other = F.slice(F.filter("_list", lambda x: x["neighbour"] != F.col("id")), 1, k)
    found = back.select("id", F.posexplode(other).alias("_p", "_x"))
    return found.select(F.col("id").alias(id), F.col("_x.neighbour").alias("neighbour"), F.col("_x.dist").alias("distance"),
                        (F.col("_p") + 1).alias("rank"))
