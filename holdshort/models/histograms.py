"""Histograms of bins on blocks of rows, in numpy: what the tasks and the driver of `models/trees.py` compute.

Values are cut into at most `maxBins` bins per feature, as Spark does, and the bins of features that have few
combinations with one another (the slots of a one-hot code) share one code. Rows are blocks of such codes, some bytes a
row. Bags are drawn from a seed, the tree and the block, and the node of a row from its codes, so nothing is kept per row
and tree. Workers import this module, so it leaves Spark's libraries alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

#: Rows of a block.
BLOCK = 131_072
#: Combinations of bins that features of one code have in the sample, and places that their numbering may take.
COMBINATIONS, PLACES = 128, 2**20
#: Levels that one word of 32 bits tells apart.
STRIDE = 5


@dataclass
class Layout:
    """Bins of features and codes of rows."""

    cuts: list  # per feature: limits of bins, or None where bins are categories
    arity: list  # bins per feature
    groups: list  # features of each code
    values: list = field(default_factory=list)  # per code: the numbers of the bins' combinations, sorted
    spread: list = field(default_factory=list)  # per code: (combination, bin of its features) as 0 and 1

    def bins(self, x: np.ndarray, strict: bool = True) -> list[np.ndarray]:
        """Bins by feature; a value that is no category is an error, or else one more bin."""
        out, x = [], np.ascontiguousarray(x.T)
        for f, (cuts, arity) in enumerate(zip(self.cuts, self.arity)):
            if cuts is not None:
                out.append(np.searchsorted(cuts, x[f], side="left").astype(np.int32))
                continue
            with np.errstate(invalid="ignore"):
                whole = x[f].astype(np.int32)
            odd = (whole != x[f]) | (whole < 0) | (whole >= arity)
            if strict and odd.any():
                raise ValueError(f"feature {f} has values that are none of its {arity} categories")
            out.append(np.where(odd, arity, whole).astype(np.int32))
        return out

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """(code, row): the number of the row's combination of bins."""
        bins = self.bins(x)
        out = np.zeros((len(self.groups), len(x)), np.int32)
        for g, group in enumerate(self.groups):
            for f in group:
                out[g] = out[g] * self.arity[f] + bins[f]
        return out

    def observe(self, seen: list) -> None:
        """Number the combinations that occur."""
        self.values = [np.array(sorted(s), np.int64) for s in seen]
        self.spread = []
        for values, group in zip(self.values, self.groups):
            parts, rest = [], values
            for f in reversed(group):
                rest, place = np.divmod(rest, self.arity[f])
                parts.append(np.eye(self.arity[f])[place])
            self.spread.append(np.concatenate(parts[::-1], 1))

    @property
    def widths(self) -> list[int]:
        return [len(v) for v in self.values]

    @property
    def order(self) -> list[int]:
        """Features in the order of their bins in the sums."""
        return [f for group in self.groups for f in group]


def vectors(column) -> np.ndarray:
    """Rows of a column of lists, which have one length."""
    widths = np.unique(np.diff(column.offsets.to_numpy()))
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {widths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cuts(values: np.ndarray, most: int) -> np.ndarray:
    """Limits of at most `most` + 1 bins: between all values, or else where their counts come nearest to even parts."""
    found, counts = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    stride = len(values) / (most + 1)
    out, current, target = [], counts[0], stride
    for i in range(1, len(found)):
        previous, current = current, current + counts[i]
        if abs(previous - target) < abs(current - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def layout(sample: np.ndarray, categories: dict[int, int], max_bins: int) -> Layout:
    cuts = [None if f in categories else _cuts(sample[:, f], max_bins - 1) for f in range(sample.shape[1])]
    layout = Layout(cuts, [categories[f] if c is None else len(c) + 1 for f, c in enumerate(cuts)], [])
    if not cuts:
        return layout
    bins, joint, places = layout.bins(sample), None, 1
    for f, arity in enumerate(layout.arity):
        wider = None if joint is None or places * arity > PLACES else joint * arity + bins[f]
        if wider is not None and len(np.unique(wider)) <= COMBINATIONS:
            layout.groups[-1].append(f)
            joint, places = wider, places * arity
        else:
            layout.groups.append([f])
            joint, places = bins[f], arity
    return layout


def pack(layout: Layout):
    """Rows (x, y) to blocks of numbers and targets."""
    def run(batches):
        place, parts, rows = TaskContext.get().partitionId() << 32, [], 0

        def block():
            numbers = np.concatenate([p[0] for p in parts], 1)
            y = np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int64()), pa.array([numbers.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                ["block", "codes", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column("x").null_count or batch.column("y").null_count:
                raise ValueError("features and labels must not be null")
            x, y = vectors(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isfinite(y).all() or np.isnan(x).any():
                raise ValueError("features and labels must be numbers")
            parts.append((layout.numbers(x), y))
            rows += len(y)
            if rows >= BLOCK:
                yield block()
                place, parts, rows = place + 1, [], 0
        if rows:
            yield block()
    return run


def seen(groups: int):
    """The numbers of each block, once each."""
    def run(rows):
        found = [set() for _ in range(groups)]
        for row in rows:
            for s, numbers in zip(found, np.frombuffer(row.codes, np.int32).reshape(groups, -1)):
                s.update(np.unique(numbers).tolist())
        yield found
    return run


def recode(layout: Layout, kind):
    def run(batches):
        for batch in batches:
            for block, codes, y in zip(*[batch.column(c) for c in ("block", "codes", "y")]):
                numbers = np.frombuffer(codes.as_buffer(), np.int32).reshape(len(layout.groups), -1)
                out = np.stack([np.searchsorted(v, n) for v, n in zip(layout.values, numbers)]).astype(kind)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int64()), pa.array([out.tobytes()], pa.binary()),
                                                  pa.array([y.as_py()], pa.binary())], ["block", "codes", "y"])
    return run


BLOCKS = "block long, codes binary, y binary"


@dataclass
class Node:
    depth: int
    n: float = 0.0
    s: float = 0.0
    q: float = math.nan
    feature: int = -1
    left_bins: np.ndarray | None = None
    gain: float = -1.0
    left: Node | None = None
    right: Node | None = None

    @property
    def value(self) -> float:
        return self.s / self.n if self.n else 0.0


def leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else leaves(node.left) + leaves(node.right)


def router(layout: Layout, root: Node, wanted: list[Node]) -> list:
    """Stages that lead a row from its codes to the place of its node in `wanted`, len(wanted) if it is none of them.

    A node's rows are those whose codes are, one by one, among the codes that its path allows. A stage tells up to 32
    nodes apart by one bit each: the bits that all codes of a row allow leave one.
    """
    place = {id(n): i for i, n in enumerate(wanted)}
    deepest = max((n.depth for n in wanted), default=0)
    home = {f: (g, sum(layout.arity[e] for e in group[:k])) for g, group in enumerate(layout.groups) for k, f in enumerate(group)}
    stages, roots = [], [root]
    for start in range(0, deepest, STRIDE):
        masks = [np.zeros((len(roots) + 1, w), np.uint32) for w in layout.widths]
        following = np.zeros((len(roots) + 1, 32), np.int32)
        after, end = [], start + STRIDE >= deepest
        for at, top in enumerate(roots):
            stack, bit = [(top, [None] * len(masks))], 0
            while stack:
                node, allowed = stack.pop()
                if node.left is not None and id(node) not in place and node.depth < start + STRIDE:
                    g, first = home[node.feature]
                    left = layout.spread[g][:, first:first + layout.arity[node.feature]] @ node.left_bins > 0
                    for child, here in ((node.left, left), (node.right, ~left)):
                        mine = list(allowed)
                        mine[g] = here if mine[g] is None else mine[g] & here
                        stack.append((child, mine))
                    continue
                for mask, here in zip(masks, allowed):
                    mask[at] |= np.uint32(1 << bit) if here is None else np.where(here, np.uint32(1 << bit), np.uint32(0))
                if end:
                    following[at, bit] = place.get(id(node), len(wanted))
                elif node.left is not None or id(node) in place:
                    following[at, bit] = len(after)
                    after.append(node)
                else:
                    following[at, bit] = -1
                bit += 1
        # one more root takes the rows that have ended elsewhere
        for mask in masks:
            mask[-1] = 1
        following[-1, 0] = len(wanted) if end else -1
        following[following < 0] = len(after)
        stages.append(([m.reshape(-1).view(np.int32) for m in masks], following.reshape(-1)))
        roots = after
    return stages


def places(stages: list, codes: list, widths: list) -> np.ndarray:
    at = None
    for masks, following in stages:
        bits = None
        for mask, code, width in zip(masks, codes, widths):
            allowed = mask.take(code if at is None else at * width + code)
            bits = allowed if bits is None else np.bitwise_and(bits, allowed, out=bits)
        # the exponent of a number with one bit set is the bit's place
        bit = ((bits.astype(np.float32).view(np.int32) >> 23) & 255) - 127
        at = following.take(bit if at is None else at * 32 + bit)
    return np.zeros(len(codes[0]), np.intp) if at is None else at


def _bag(seed: int, tree: int, block: int, n: int, rate: float, replace: bool) -> tuple[np.ndarray | slice, np.ndarray]:
    """Places and weights of the rows that a tree draws from a block."""
    if not replace and rate >= 1:
        return slice(None), np.ones(n)
    draws = np.random.SFC64([seed & (2**64 - 1), tree, block]).random_raw((n + 1) // 2).view(np.uint32)[:n]
    limit = lambda share: np.uint32(min(round(share * 2**32), 2**32 - 1))
    if not replace:
        at = np.flatnonzero(draws < limit(rate))
        return at, np.ones(len(at))
    # Poisson weights: as many as the distribution function's steps up to the draw
    more = chance = math.exp(-rate)
    at = np.flatnonzero(draws >= limit(more))
    draws = draws.take(at)
    weight = np.ones(len(at), np.uint8)
    for k in range(1, 64):
        chance *= rate / k
        more += chance
        weight += draws >= limit(more)
        if chance < 2**-34 and k > rate:
            break
    return at, weight.astype(float)


@dataclass
class Job:
    """What a pass over the blocks needs; `shifts` are (stages, values) of trees to take off the targets."""

    layout: Layout
    kind: str
    seed: int
    rate: float
    replace: bool
    shifts: list
    factor: float = 1.0

    def blocks(self, rows):
        for row in rows:
            yield row.block, list(np.frombuffer(row.codes, self.kind).reshape(len(self.layout.groups), -1).astype(np.int32)), np.frombuffer(row.y)

    def drawn(self, tree: int, block: int, codes: list, y: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
        """Codes, weights and targets of the rows that a tree draws from a block."""
        at, weight = _bag(self.seed, tree, block, len(y), self.rate, self.replace)
        if isinstance(at, np.ndarray):
            codes, y = [c.take(at) for c in codes], y.take(at)
        target = self.target(codes, y)
        return codes, weight, target if self.factor == 1 else target * self.factor

    def target(self, codes, y):
        for stages, values in self.shifts:
            y = y - values.take(places(stages, codes, self.layout.widths))
        return y


def level(shared):
    """Sums of a batch of (tree, stages, nodes, features by node): (batch place, (weights and targets per bin, per node))."""
    def run(rows):
        job, batch = shared.value
        widths, sums = job.layout.widths, None
        for block, codes, y in job.blocks(rows):
            if sums is None:
                sums = [([np.zeros((2, (m + 1) * w)) for w in widths], np.zeros(m + 1)) for _, _, m, _ in batch]
            for (tree, stages, m, _), (bins, squares) in zip(batch, sums):
                mine, weight, target = job.drawn(tree, block, codes, y)
                weighted = weight * target
                node = places(stages, mine, widths)
                squares += np.bincount(node, weighted * target, m + 1)
                for total, code, width in zip(bins, mine, widths):
                    key = node * width + code if stages or m > 1 else code
                    total[0] += np.bincount(key, weight, total.shape[1])
                    total[1] += np.bincount(key, weighted, total.shape[1])
        for i, (_, _, m, features) in enumerate(batch if sums else []):
            bins, squares = sums[i]
            both = [[t.reshape(m + 1, -1)[:m] @ s for s, t in zip(job.layout.spread, [b[k] for b in bins])] for k in (0, 1)]
            mask = np.repeat(features[:, job.layout.order], [job.layout.arity[f] for f in job.layout.order], axis=1)
            totals = np.stack([b.reshape(2, m + 1, -1)[:, :m].sum(2) for b in bins[:1]][0].tolist() + [squares[:m]])
            yield i, (*[np.concatenate(b, 1)[mask] for b in both], totals)
    return run


def best_splits(layout: Layout, weights: np.ndarray, targets: np.ndarray, features: np.ndarray, totals: np.ndarray, least: int, gain: float) -> list:
    """Per node its best split (feature, bins to the left, gain, weight and target of the left side), None without one."""
    n, s, q = totals
    best = [None] * len(n)
    most = np.full(len(n), -np.inf)
    floor = np.maximum(gain, 1e-14 * np.nan_to_num(q) / np.maximum(n, 1))
    first, starts = 0, {}
    for f in layout.order:
        starts[f] = first
        first += layout.arity[f]
    for f in sorted(starts):
        arity, nodes = layout.arity[f], np.flatnonzero(features[:, f])
        if arity < 2 or not len(nodes):
            continue
        w, t = (a[nodes, starts[f]:starts[f] + arity] for a in (weights, targets))
        order = None
        if layout.cuts[f] is None:
            order = np.argsort(np.where(w > 0, t / np.where(w > 0, w, 1), np.inf), axis=1, kind="stable")
            w, t = np.take_along_axis(w, order, 1), np.take_along_axis(t, order, 1)
        lw, lt = w.cumsum(1)[:, :-1], t.cumsum(1)[:, :-1]
        rw, rt = n[nodes, None] - lw, s[nodes, None] - lt
        good = (lw >= max(least, 1e-9)) & (rw >= max(least, 1e-9))
        won = np.where(good, lt * lt / np.where(good, lw, 1) + rt * rt / np.where(good, rw, 1) - (s * s / np.maximum(n, 1e-9))[nodes, None], -np.inf)
        won = won / np.maximum(n, 1e-9)[nodes, None]
        at = won.argmax(1)
        for k in np.flatnonzero((won[np.arange(len(nodes)), at] > most[nodes]) & (won[np.arange(len(nodes)), at] > floor[nodes])):
            node, cut = nodes[k], at[k]
            left = np.arange(arity) <= cut if order is None else np.isin(np.arange(arity), order[k, :cut + 1])
            most[node] = won[k, cut]
            best[node] = (f, left, float(won[k, cut]), float(lw[k, cut]), float(lt[k, cut]))
    return best


def split(node: Node, found: tuple) -> list[Node]:
    node.feature, node.left_bins, node.gain, n, s = found
    node.left, node.right = Node(node.depth + 1, n, s), Node(node.depth + 1, node.n - n, node.s - s)
    return [node.left, node.right]


def triples(shared):
    """Weights and targets by three codes at a time."""
    def run(rows):
        job, tree, threes = shared.value
        widths, sums = job.layout.widths, None
        for block, codes, y in job.blocks(rows):
            if sums is None:
                sums = [np.zeros((2, math.prod(widths[g] for g in three))) for three in threes]
            mine, _, target = job.drawn(tree, block, codes, y)
            for total, three in zip(sums, threes):
                key = mine[three[0]]
                for g in three[1:]:
                    key = key * widths[g] + mine[g]
                total[0] += np.bincount(key, None, total.shape[1])  # weights are one
                total[1] += np.bincount(key, target, total.shape[1])
        if sums:
            yield sums
    return run


def flat(layout: Layout, root: Node) -> list[tuple]:
    """Nodes in the order of Spark's files: a node, its left part, its right part."""
    out, stack = [], [(root, None, 0)]
    while stack:
        node, parent, side = stack.pop()
        at = len(out)
        if parent is not None:
            out[parent][6 + side] = at
        impurity = max(node.q - node.s * node.s / node.n, 0.0) / node.n if node.n else math.nan
        stats = [node.n, node.s, node.q]
        if node.left is None:
            out.append([at, node.value, impurity, stats, round(node.n), -1.0, -1, -1, (-1, [], -1)])
            continue
        cuts = layout.cuts[node.feature]
        split = ((node.feature, [float(cuts[int(node.left_bins.sum()) - 1])], -1) if cuts is not None
                 else (node.feature, [float(b) for b in np.flatnonzero(node.left_bins)], layout.arity[node.feature]))
        out.append([at, node.value, impurity, stats, round(node.n), node.gain, -1, -1, split])
        stack += [(node.right, at, 1), (node.left, at, 0)]
    return [tuple(x) for x in out]


class Forest:
    """Trees as tables, for predictions."""

    def __init__(self, layout: Layout, trees: list):
        self.layout, self.tables = layout, []
        most = max(layout.arity, default=1) + 1
        for weight, root in trees:
            nodes = [root]
            for node in nodes:
                nodes += [] if node.left is None else [node.left, node.right]
            place = {id(n): i for i, n in enumerate(nodes)}
            feature, following = np.zeros(len(nodes), np.intp), np.repeat(np.arange(len(nodes)), most).reshape(-1, most)
            for i, node in enumerate(nodes):
                if node.left is not None:
                    left, right, bins = place[id(node.left)], place[id(node.right)], node.left_bins
                    feature[i] = node.feature
                    following[i, :len(bins)] = np.where(bins, left, right)
                    # other categories than the known ones: to the side that has more of them
                    following[i, len(bins):] = right if bins.sum() <= len(bins) // 2 else left
            self.tables.append((feature, following.reshape(-1), weight * np.array([n.value for n in nodes]), max(n.depth for n in nodes)))
        self.width = most

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        if not len(x):
            return total
        if x.shape[1] != len(self.layout.cuts):
            raise ValueError(f"vectors of {x.shape[1]} features instead of {len(self.layout.cuts)}")
        bins = np.stack(self.layout.bins(x, strict=False)).astype(np.intp).reshape(-1)
        rows = np.arange(len(x))
        for feature, following, values, depth in self.tables:
            at = np.zeros(len(x), np.intp)
            for _ in range(depth):
                at = following.take(at * self.width + bins.take(feature.take(at) * len(x) + rows))
            total += values.take(at)
        return total
