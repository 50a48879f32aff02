"""Histogram gradient boosting with leaf-wise growth, on binned rows.

Feature values are cut into at most ``MAX_BINS`` bins once, and bins are packed into codes (``lines``).  Trees grow best leaf first: the leaf whose split
gains most is split next, up to ``max_leaves``.

A table of at most ``LOCAL_ROWS`` rows is boosted by one task: it keeps raw scores and the rows of every leaf, so a tree costs it a few passes over bytes, while a
round of tasks costs a job.  A larger table is stored as blocks of codes, labels, weights and raw scores.  A round is one pass
over the blocks: gradients and hessians of the logistic loss are summed per (leaf, code) in each task and per (leaf, feature, bin) across tasks, where the best split of every leaf
is looked for; the driver only sees those splits.  One round serves several splits: leaves that may be split are divided ahead, so the upper part of a tree takes as many rounds as it is
deep, not one per split.  The rows of a leaf of at most ``GROUP_ROWS`` meet in one group, which grows the whole subtree below it by the same sums.  Sums and such rows travel in the
same pass, and the group of a leaf returns its split or its subtree.  What was found ahead in vain is left out.

Sums are whole numbers (gradients in fixed point), so a model does not depend on how rows are partitioned or in which order tasks end.
The fitted model is MLlib's ``GBTClassificationModel``: it scores in the JVM and is saved and loaded like any other.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators.lines import CHUNK, Lines, line_sums, line_task, parted_rows, plan_of
from txnrisk.session import discard, working_path

MAX_BINS = 255
SKETCH_ACCURACY = 10_000
BLOCK_ROWS = 1 << 16
LOCAL_ROWS = 1 << 23      # of a table that one task boosts: some 60 bytes each
GROUP_ROWS = 1 << 17      # of a leaf whose subtree is grown by one group: some 3 MB
MOST_LEAVES = 62          # of a tree whose leaves are bits of a number
MANY_ROWS = 1 << 10       # from which features are summed one by one
STORE_EVERY = 5           # trees after which raw scores are stored anew
LEAST_HESSIAN = 1e-3      # of a split's either side
FIXED_POINT_BITS = 30
# Rounds are many and short: a plan that is settled beforehand, few reducers (sums are bounded by leaves, features and bins), and few blocks in memory at once.
ROUND_CONF = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


@dataclass
class Tree:
    """Nodes in arrays; ``left`` is 0 at leaves (the root is nobody's child)."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])      # rows whose bin is at most this go left
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def divide(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        child = len(self.left)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, child
        for _ in range(2):
            self.feature.append(0)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(0.0)
        return child, child + 1

    def inner(self, wanted: Iterable[int] | None = None) -> dict[int, tuple[int, int, int]]:
        """Feature, cut and left child of every node that is split, or of those above the ``wanted`` ones."""
        if wanted is None:
            return {n: (self.feature[n], self.cut[n], child) for n, child in enumerate(self.left) if child}
        parent = {c: n for n, child in enumerate(self.left) if child for c in (child, child + 1)}
        out: dict[int, tuple[int, int, int]] = {}
        for n in wanted:
            while n and (n := parent[n]) not in out:
                out[n] = (self.feature[n], self.cut[n], self.left[n])
        return out


def parted(bins: np.ndarray, inner: dict[int, tuple[int, int, int]], wanted: Container[int] | None = None, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray | slice]]:
    """The rows (of some, or of all) at every node that is not split, or at the ``wanted`` ones; ``bins`` has a line per feature."""
    held: list[tuple[int, np.ndarray | slice]] = [(0, slice(None) if rows is None else rows)]
    while held:
        node, own = held.pop()
        if node not in inner:
            if wanted is None or node in wanted:
                yield node, own
            continue
        feature, cut, child = inner[node]
        low = bins[feature][own] <= cut
        for c, side in ((child, low), (child + 1, ~low)):
            if wanted is None or c in inner or c in wanted:
                part = np.flatnonzero(side) if isinstance(own, slice) else own[side]
                if len(part):
                    held.append((c, part))


@dataclass
class Leaf:
    """Sums over a node's rows and, once its histogram is known, its best split."""

    g: float
    h: float
    n: int
    split: tuple | None = None          # (gain, feature, cut, left sums, right sums)
    children: tuple[int, int] | None = None


def best_split(cells: np.ndarray, leaf: Leaf, min_rows: int, l2: float) -> tuple | None:
    """The split with the largest gain from sums (feature, bin, [g, h, n]); the smallest feature and cut among equals."""
    below = np.cumsum(cells, axis=1)
    g, h, n = below[..., 0], below[..., 1], below[..., 2]
    rg, rh, rn = leaf.g - g, leaf.h - h, leaf.n - n
    allowed = (n >= min_rows) & (rn >= min_rows) & (h >= LEAST_HESSIAN) & (rh >= LEAST_HESSIAN)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, g * g / (h + l2) + rg * rg / (rh + l2) - leaf.g**2 / (leaf.h + l2), -np.inf)
    at = int(np.argmax(gain))
    feature, cut = divmod(at, gain.shape[1])
    if not gain[feature, cut] > 0:
        return None
    left = (float(g[feature, cut]), float(h[feature, cut]), int(n[feature, cut]))
    right = (float(rg[feature, cut]), float(rh[feature, cut]), int(rn[feature, cut]))
    return float(gain[feature, cut]), feature, cut, left, right


def order_of(split: tuple) -> tuple[float, int, int]:
    """Larger gains come first, then smaller features and cuts."""
    return -split[0], split[1], split[2]


def column_sums(column: np.ndarray, size: int, g: np.ndarray, h: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Sums (bin, [g, h, n]) of rows with ``total`` sums, by a feature of ``size`` bins; whole numbers below 2**53."""
    if size == 1:
        return total[None]
    if size == 2:  # one bin is summed, the other has what is left, exactly
        second = np.flatnonzero(column)
        sums = np.array([g[second].sum(), h[second].sum(), len(second)])
        return np.stack([total - sums, sums])
    column = column.astype(np.intp)
    return np.stack([np.bincount(column, x, size) for x in (g, h, None)], axis=1)


def histogram(bins: np.ndarray, g: np.ndarray, h: np.ndarray, size: int = 256) -> np.ndarray:
    """Sums (feature, bin, [g, h, n]) of rows whose bins are below ``size``; whole numbers below 2**53."""
    if len(g) > MANY_ROWS:
        out, total = np.zeros((len(bins), size, 3)), np.array([g.sum(), h.sum(), len(g)])
        for sums, row in zip(out, bins):
            used = int(row.max()) + 1
            sums[:used] = column_sums(row, used, g, h, total)
        return out
    cell = (bins + (np.arange(len(bins)) * size)[:, None]).ravel()
    sums = [np.bincount(cell, x, len(bins) * size) for x in (np.tile(g, len(bins)), np.tile(h, len(bins)), None)]
    return np.stack(sums, axis=1).reshape(len(bins), size, 3)


def packed(columns: Iterable[np.ndarray], sizes: Iterable[int], g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums ([g, h, n], cell) of rows; a feature has as many cells as bins."""
    total = np.array([g.sum(), h.sum(), len(g)])
    return np.concatenate([column_sums(c, n, g, h, total) for c, n in zip(columns, sizes)]).T.astype(np.int64)


def unpacked(sums: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Sums (feature, bin, [g, h, n]) from ``packed`` ones."""
    out, start = np.zeros((len(sizes), max(sizes), 3), np.int64), 0
    for cells, n in zip(out, sizes):
        cells[:n] = sums[:, start:start + n].T
        start += n
    return out


def best_of(plan: Lines, cells: np.ndarray, leaf: Leaf, min_rows: int, l2: float) -> tuple | None:
    """``best_split``, with features of two bins apart from those of many, which take most cells."""
    found = []
    for own in plan.groups:
        if len(own) and (split := best_split(cells[own, :max(plan.sizes[f] for f in own)], leaf, min_rows, l2)):
            found.append((split[0], int(own[split[1]]), *split[2:]))
    return min(found, key=order_of, default=None)


def grow_rows(plan: Lines, codes: list[np.ndarray], g: np.ndarray, h: np.ndarray, scale: float, max_leaves: int, min_rows: int, l2: float) -> tuple[list[tuple], dict[int, np.ndarray]]:
    """Best-first splits of some rows: (node, feature, cut, gain, left sums, right sums); node 0 are all of them, split k has children 2k+1 and 2k+2.

    Also the rows of every node that is not split.
    """
    out, heap, held, rows_of = [], [], {}, {0: np.arange(len(g), dtype=np.int32)}
    units = np.array([scale, scale, 1.0])

    def offer(node: int, sums: list[np.ndarray]) -> None:
        total = sums[0].sum(axis=1) if sums else np.array([g.sum(), h.sum(), len(g)]).astype(np.int64)
        leaf = Leaf(*(total / units))
        if leaf.n >= 2 * min_rows and (split := best_of(plan, plan.cells(sums, total) / units, leaf, min_rows, l2)):
            held[node] = (sums, split)
            heapq.heappush(heap, (*order_of(split), leaf.n, node))

    offer(0, line_sums(plan, codes, g, h))
    while heap and len(out) < max_leaves - 1:
        node = heapq.heappop(heap)[-1]
        sums, (gain, feature, cut, left, right) = held.pop(node)
        child = 2 * len(out) + 1
        out.append((node, feature, cut, gain, *left, *right))
        line, low = plan.low(feature, cut)
        parts = parted_rows(codes[line], low, rows_of.pop(node))
        rows_of.update({child: parts[0], child + 1: parts[1]})
        if len(out) < max_leaves - 1:
            few = int(len(parts[1]) < len(parts[0]))
            own = line_sums(plan, codes, g, h, parts[few])
            rest = [a - b for a, b in zip(sums, own)]  # the other part has what is left, exactly
            offer(child + few, own)
            offer(child + 1 - few, rest)
    return out, rows_of


def tree_of(splits: list[tuple], step: float, l2: float) -> tuple[Tree, dict[int, int]]:
    """The tree of best-first splits with its leaf values, and where its unsplit nodes are in it; without any split a tree adds nothing."""
    out, place = Tree(), {0: (0, 0.0, 0.0)}
    for k, (node, feature, cut, _, lg, lh, _, rg, rh, _) in enumerate(splits):
        at = out.divide(place.pop(node)[0], feature, cut)
        place[2 * k + 1], place[2 * k + 2] = (at[0], lg, lh), (at[1], rg, rh)
    for where, g, h in place.values():
        out.value[where] = -step * g / (h + l2)
    return out, {node: where for node, (where, _, _) in place.items()}


# --------------------------------------------------------------------------- blocks

BLOCKS_DDL = "rows long, bins binary, label binary, weight binary, score binary"
BLOCKS = pa.schema([("rows", pa.int64()), *((c, pa.binary()) for c in ("bins", "label", "weight", "score"))])


def bin_bounds(df: DataFrame, width: int, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Per element of the array column ``x`` the upper bounds of all bins but the last: midpoints between values, or between quantiles where values are many."""
    probs = [i / max_bins for i in range(max_bins + 1)]
    distinct = df.agg(F.array(*[F.approx_count_distinct(F.col("x")[j]) for j in range(width)]).alias("distinct")).first()["distinct"]
    few = {j for j in range(width) if distinct[j] <= max_bins * 0.8}  # the estimate is off by some percent
    found = df.agg(*[
        (F.collect_set(F.col("x")[j]) if j in few else F.percentile_approx(F.col("x")[j], probs, SKETCH_ACCURACY)).alias(f"v{j}") for j in range(width)]).first()
    out = []
    for j in range(width):
        values = np.unique(np.array(found[f"v{j}"] or [], float))
        values = values[~np.isnan(values)]
        middle = values[:-1] + (values[1:] - values[:-1]) / 2
        out.append(np.where(middle < values[1:], middle, values[:-1]))
    return out


def block_task(bounds: list[np.ndarray], start: float):
    """Task that packs rows (x, label, weight) into blocks with the same raw score everywhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def block() -> pa.RecordBatch:
            x, y, w = (np.concatenate(c) for c in zip(*held))
            bins = np.stack([np.searchsorted(b, x[:, j]).astype(np.uint8) for j, b in enumerate(bounds)])
            cells = [len(y), bins.tobytes(), y.tobytes(), w.tobytes(), np.full(len(y), start).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, BLOCKS)], schema=BLOCKS)

        for b in batches:
            if not b.num_rows:
                continue
            x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            held.append((x, b["label"].to_numpy(zero_copy_only=False).astype(float), b["weight"].to_numpy(zero_copy_only=False).astype(float)))
            rows += b.num_rows
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
        if held:
            yield block()
    return run


class Route:
    """The way of rows to the unsplit nodes of a tree, by tables over codes.

    Every line's table has a bit per leaf that its features do not rule out; of the leaves that no line rules out a row is in the first.
    """

    def __init__(self, plan: Lines, inner: dict[int, tuple[int, int, int]]):
        self.plan, self.inner, self.leaves, self.masks = plan, inner, [], {}
        spans: dict[int, tuple[int, int]] = {}

        todo = [(0, False)]
        while todo:  # leaves from left to right; the span of a node once its children are known
            node, again = todo.pop()
            if node not in inner:
                spans[node] = (len(self.leaves), len(self.leaves) + 1)
                self.leaves.append(node)
            elif again:
                spans[node] = (spans[inner[node][2]][0], spans[inner[node][2] + 1][1])
            else:
                todo += [(node, True), (inner[node][2] + 1, False), (inner[node][2], False)]
        if len(self.leaves) <= MOST_LEAVES:
            for feature, cut, child in inner.values():
                line, low = plan.low(feature, cut)
                a, z = spans[child]
                mask = self.masks.setdefault(line, np.full(plan.codes[line], -1, np.int64))
                mask[~low] &= ~np.int64((1 << z) - (1 << a))

    def __call__(self, codes: list[np.ndarray], rows: int) -> np.ndarray:
        """Per row the number of its leaf in ``leaves``; ``codes`` can index a table."""
        if len(self.leaves) > MOST_LEAVES:
            at, number = np.zeros(rows, np.int64), np.zeros(max(self.leaves) + 1, np.intp)
            for node in sorted(self.inner):  # children come after their parents
                feature, cut, child = self.inner[node]
                line, low = self.plan.low(feature, cut)
                own = np.flatnonzero(at == node)
                at[own] = np.where(low.take(codes[line].take(own)), child, child + 1)
            number[self.leaves] = np.arange(len(self.leaves))
            return number.take(at)
        left = None
        for line, mask in self.masks.items():
            own = mask.take(codes[line])
            left = own if left is None else np.bitwise_and(left, own, out=left)
        if left is None:
            return np.zeros(rows, np.intp)
        return ((left & -left).astype(np.float64).view(np.int64) >> 52) - 1023


def opened(batches: Iterator[pa.RecordBatch], plan: Lines, trees: list[Tree]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, dict]]:
    """Codes, labels, weights and present raw scores of each block, and its stored cells."""
    routes = [Route(plan, t.inner()) for t in trees]
    values = [np.array([t.value[n] for n in r.leaves]) for t, r in zip(trees, routes)]
    for b in batches:
        for cells in b.to_pylist():
            codes = [c.astype(np.intp) for c in plan.split(cells["bins"], cells["rows"])]
            label, weight, score = (np.frombuffer(cells[c]) for c in ("label", "weight", "score"))
            score = score.copy()
            for route, value in zip(routes, values):
                score += value.take(route(codes, len(score)))
            yield codes, label, weight, score, cells


def whole_task(plan: Lines, scale: float, boosting: HistogramBoosting):
    """Task over all blocks of bins: the splits of every tree, each found on the scores after the one before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in (*plan.held, "label", "weight", "score")]
        for b in batches:
            for cells in b.to_pylist():
                columns = [*plan.pack(np.frombuffer(cells["bins"], np.uint8).reshape(len(plan.sizes), cells["rows"])), *(np.frombuffer(cells[c]) for c in ("label", "weight", "score"))]
                if (columns[-3] == (short := columns[-3].astype(np.uint8))).all():
                    columns[-3] = short
                for own, c in zip(held, columns):
                    own.append(c)
        for k, own in enumerate(held):
            held[k] = np.concatenate(own)
        *codes, label, weight, score = held
        g, h = np.empty(len(score)), np.empty(len(score))
        for k in range(boosting.max_iter):
            for a in range(0, len(g), CHUNK):
                own = slice(a, a + CHUNK)
                g[own], h[own] = slopes(label[own], weight[own], score[own], scale)
            splits, rows_of = grow_rows(plan, codes, g, h, scale, boosting.max_leaves, boosting.min_rows, boosting.l2)
            tree, where = tree_of(splits, boosting.step, boosting.l2)
            for node, rows in rows_of.items():
                for a in range(0, len(rows), CHUNK):
                    score[rows[a:a + CHUNK]] += tree.value[where[node]]
            yield as_batch([(k, *x) for x in splits], SPLITS)
    return run


def slopes(label: np.ndarray, weight: np.ndarray, score: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the logistic loss in fixed point."""
    share = 1 / (1 + np.exp(-score))
    return np.rint((share - label) * weight * scale), np.rint(share * (1 - share) * weight * scale)


# Of some rows of a node: codes, gradients and hessians; or, without codes, sums per cell.
PARTS_DDL = "slot long, bins binary, g binary, h binary, n binary"
PARTS = pa.schema([("slot", pa.int64()), *((c, pa.binary()) for c in ("bins", "g", "h", "n"))])
SPLITS = pa.schema([(c, pa.int64() if c in ("slot", "node", "feature", "cut", "ln", "rn") else pa.float64()) for c in (
    "slot", "node", "feature", "cut", "gain", "lg", "lh", "ln", "rg", "rh", "rn")])
SPLITS_DDL = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double'}" for f in SPLITS)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def pass_task(plan: Lines, trees: list[Tree], tree: Tree, many: dict[int, int], few: dict[int, int], scale: float):
    """Task over blocks: fixed-point sums of the nodes in ``many``, the rows of those in ``few`` (node -> slot)."""
    inner = tree.inner({**many, **few})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, nodes, total = Route(plan, inner), list(many), None
        number = np.array([nodes.index(n) if n in many else len(nodes) for n in route.leaves])  # the last one's sums are not wanted
        for codes, label, weight, score, cells in opened(batches, plan, trees):
            g, h = slopes(label, weight, score, scale)
            at, out = route(codes, len(g)), []
            for i, n in enumerate(route.leaves):
                if n in few and len(rows := np.flatnonzero(at == i)):
                    own = b"".join(c[rows].tobytes() for c in plan.split(cells["bins"], len(g)))
                    out.append((few[n], own, g[rows].tobytes(), h[rows].tobytes(), None))
            if out:
                yield as_batch(out, PARTS)
            if nodes:
                at = number.take(at)
                total = total or [np.zeros((3, len(nodes) + 1, n), np.int64) for n in plan.codes or [1]]
                wanted = np.flatnonzero(at < len(nodes))
                if 2 * len(wanted) < len(at):
                    at, g, h, codes = at.take(wanted), g.take(wanted), h.take(wanted), [c.take(wanted) for c in codes]
                for sums, code in zip(total, codes or [np.zeros(len(at), np.intp)]):
                    cell = at * sums.shape[2] + code
                    for s, x in zip(sums, (g, h, None)):
                        s += np.bincount(cell, x, s.size).reshape(s.shape).astype(np.int64)
        for k, n in enumerate(nodes if total else ()):
            all_rows = total[0][:, k].sum(axis=1)
            cells = plan.cells([sums[:, k] for sums in total] if plan.codes else [], all_rows)
            if all_rows[2]:
                packed_cells = np.concatenate([own[:size] for own, size in zip(cells, plan.sizes)]).T
                yield as_batch([(many[n], None, *(np.ascontiguousarray(x).tobytes() for x in packed_cells))], PARTS)
    return run


def settle_task(plan: Lines, scale: float, max_leaves: int, min_rows: int, l2: float):
    """Task over what was sent of one node: its best split from sums, its subtree from rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, slot = [], None, 0
        for b in batches:
            for part in b.to_pylist():
                slot = part["slot"]
                if part["bins"] is not None:
                    rows.append(part)
                else:
                    sums = np.stack([np.frombuffer(part[c], np.int64) for c in "ghn"])
                    total = sums if total is None else total + sums
        if rows:
            g, h = (np.frombuffer(b"".join(p[c] for p in rows)) for c in "gh")
            codes = [np.concatenate(c) for c in zip(*(plan.split(p["bins"], len(p["g"]) // 8) for p in rows))]
            splits = [(slot, *s) for s in grow_rows(plan, codes, g, h, scale, max_leaves, min_rows, l2)[0]]
        else:
            cells = unpacked(total, plan.sizes) / np.array([scale, scale, 1.0])
            split = best_of(plan, cells, Leaf(*cells[0].sum(axis=0)), min_rows, l2)
            splits = [(slot, 0, split[1], split[2], split[0], *split[3], *split[4])] if split else []
        yield as_batch(splits, SPLITS)
    return run


def rescore_task(plan: Lines, trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, score, cells in opened(batches, plan, trees):
            cells["score"] = score.tobytes()
            yield pa.RecordBatch.from_pylist([cells], schema=BLOCKS)
    return run


# --------------------------------------------------------------------------- fitting

@dataclass
class HistogramBoosting:
    """Estimator over ``features``, ``label`` (0/1) and, if named, a weight column."""

    max_iter: int = 160
    step: float = 0.06
    max_leaves: int = 15
    min_rows: int = 25
    l2: float = 2.0
    max_bins: int = MAX_BINS
    features: str = "features"
    label: str = "label"
    weight: str | None = None
    bounds: list[np.ndarray] | None = None  # of bins, if known

    def copy(self) -> HistogramBoosting:
        return HistogramBoosting(**vars(self))

    def setFeaturesCol(self, name: str) -> HistogramBoosting:  # noqa: N802 (MLlib's names)
        self.features = name
        return self

    def setLabelCol(self, name: str) -> HistogramBoosting:  # noqa: N802
        self.label = name
        return self

    def setWeightCol(self, name: str) -> HistogramBoosting:  # noqa: N802
        self.weight = name
        return self

    def fit(self, df: DataFrame) -> GBTClassificationModel:
        bounds, start, trees = self.grow(df)
        # MLlib's margin is half the raw score; the constant is a tree of one leaf.
        halves = [Tree(t.feature, t.cut, t.left, [v / 2 for v in t.value]) for t in [Tree(value=[start]), *trees]]
        return stored_ensemble(df.sparkSession, "boosting", halves, bounds)

    def grow(self, df: DataFrame) -> tuple[list[np.ndarray], float, list[Tree]]:
        """Bin bounds, the constant raw score before the first tree, and the trees."""
        rows = df.select(
            vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("label"),
            (F.col(self.weight).cast("double") if self.weight else F.lit(1.0)).alias("weight"))
        one = rows.agg(
            F.count(F.lit(1)).alias("n"), F.first(F.size("x"), ignorenulls=True).alias("width"), F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("p"),
            F.max("weight").alias("most")).first()
        if not one["n"]:
            raise ValueError("No rows to learn from.")
        share = min(max(one["p"] / one["w"], 1e-12), 1 - 1e-12)
        start, width = math.log(share / (1 - share)), one["width"]
        bounds = bin_bounds(rows, width, self.max_bins) if self.bounds is None else self.bounds
        # Fixed point: no sum over all rows leaves 62 bits.
        scale = 2.0 ** min(FIXED_POINT_BITS, 61 - math.ceil(math.log2(max(1.0, one["n"] * one["most"]))))
        spark, rounds = df.sparkSession, df.sparkSession.newSession()
        for key, value in ROUND_CONF.items():
            rounds.conf.set(key, value)
        path, stored = working_path(spark, "boosting-blocks"), 0
        rows.mapInArrow(block_task(bounds, start), BLOCKS_DDL).write.parquet(path)
        blocks, trees = rounds.read.schema(BLOCKS_DDL).parquet(path), []
        plan = plan_of(blocks, [len(b) + 1 for b in bounds])
        if one["n"] <= LOCAL_ROWS:
            found: list[list[tuple]] = [[] for _ in range(self.max_iter)]
            for r in blocks.coalesce(1).mapInArrow(whole_task(plan, scale, self), SPLITS_DDL).toArrow().to_pylist():  # at most max_leaves - 1 a tree, in order
                found[r["slot"]].append(tuple(r[f.name] for f in SPLITS)[1:])
            discard(spark, path)
            return bounds, start, [tree_of(splits, self.step, self.l2)[0] for splits in found]
        task = line_task(plan)
        for _ in range(self.max_iter + 1):
            if task:
                after = working_path(spark, "boosting-blocks")
                blocks.mapInArrow(task, BLOCKS_DDL).write.parquet(after)
                discard(spark, path)
                blocks, path, stored, task = rounds.read.schema(BLOCKS_DDL).parquet(after), after, len(trees), None
            if len(trees) < self.max_iter:
                trees.append(self.tree(blocks, plan, trees[stored:], scale, one["n"]))
            if STORE_EVERY <= len(trees) - stored and len(trees) < self.max_iter:
                task = rescore_task(plan, trees[stored:])
        discard(spark, path)
        return bounds, start, trees

    def tree(self, blocks: DataFrame, plan: Lines, since: list[Tree], scale: float, rows: int) -> Tree:
        """The next tree: rounds of histograms until the best-first order is settled."""
        ahead, leaves = Tree(), {0: Leaf(0.0, 0.0, rows)}
        self.look(blocks, plan, since, scale, ahead, leaves, [0])
        while True:
            chosen, open_nodes = self.best_first(leaves)
            if not open_nodes:
                return self.pruned(leaves, chosen)
            new = []
            for node in open_nodes:
                _, feature, cut, left, right = leaves[node].split
                leaves[node].children = ahead.divide(node, feature, cut)
                for child, sums in zip(leaves[node].children, (left, right)):
                    leaves[child] = Leaf(*sums)
                    new.append(child)
            self.look(blocks, plan, since, scale, ahead, leaves, new)

    def best_first(self, leaves: dict[int, Leaf]) -> tuple[list[int], list[int]]:
        """Nodes split so far in order of gain and, if a histogram is missing to go on, the leaves to divide ahead."""
        chosen, heap = [], []

        def offer(node: int) -> None:
            if leaves[node].split:
                heapq.heappush(heap, (*order_of(leaves[node].split), leaves[node].n, node))

        offer(0)
        while heap and len(chosen) < self.max_leaves - 1:
            node = heapq.heappop(heap)[-1]
            chosen.append(node)
            if len(chosen) < self.max_leaves - 1 and leaves[node].children is None:
                others = [n for *_, n in sorted(heap) if leaves[n].children is None]
                return chosen, [node, *others][:self.max_leaves - len(chosen)]
            for child in leaves[node].children or ():
                offer(child)
        return chosen, []

    def look(self, blocks: DataFrame, plan: Lines, since: list[Tree], scale: float, ahead: Tree, leaves: dict[int, Leaf], nodes: list[int]) -> None:
        """One pass over the blocks: best splits of ``nodes``, and of all below those with few rows (nodes too small to be split are left out)."""
        worth = [n for n in nodes if leaves[n].n >= 2 * self.min_rows]
        if not worth:
            return
        many = {n: s for s, n in enumerate(worth) if leaves[n].n > min(LOCAL_ROWS, GROUP_ROWS)}
        few = {n: s for s, n in enumerate(worth) if n not in many}
        parts = blocks.mapInArrow(pass_task(plan, since, ahead, many, few, scale), PARTS_DDL)
        splits = parts.groupBy("slot").applyInArrow(settle_task(plan, scale, self.max_leaves, self.min_rows, self.l2), SPLITS_DDL)
        names: dict[int, dict[int, int]] = {s: {0: n} for n, s in few.items()}
        order: dict[int, int] = dict.fromkeys(few.values(), 0)
        for r in splits.toArrow().to_pylist():  # at most max_leaves - 1 a node, in order of gain
            left, right = ((r[f"{side}g"], r[f"{side}h"], r[f"{side}n"]) for side in "lr")
            split = (r["gain"], r["feature"], r["cut"], left, right)
            if r["slot"] not in names:
                leaves[worth[r["slot"]]].split = split
                continue
            name, child = names[r["slot"]], 2 * order[r["slot"]] + 1
            order[r["slot"]] += 1
            at = leaves[name[r["node"]]]
            at.split, at.children = split, (-len(leaves), -len(leaves) - 1)
            for k, sums in enumerate((left, right)):
                name[child + k] = at.children[k]
                leaves[at.children[k]] = Leaf(*sums)

    def pruned(self, leaves: dict[int, Leaf], chosen: list[int]) -> Tree:
        """The tree of the chosen splits with its leaf values."""
        out, place = Tree(), {0: (0, 0.0, 0.0)}  # without any split a tree adds nothing
        for node in chosen:
            _, feature, cut, left, right = leaves[node].split
            children = leaves[node].children or ("left", "right")  # the last split's children may not have been looked at
            at = out.divide(place.pop(node)[0], feature, cut)
            for child, where, sums in zip(children, at, (left, right)):
                place[child] = (where, sums[0], sums[1])
        for where, g, h in place.values():
            out.value[where] = -self.step * g / (h + self.l2)
        return out


ENSEMBLES = {  # kinds of MLlib models: (class in the JVM, class here)
    "boosting": ("org.apache.spark.ml.classification.GBTClassificationModel", GBTClassificationModel),
    "forest": ("org.apache.spark.ml.regression.RandomForestRegressionModel", RandomForestRegressionModel),
}


def stored_ensemble(spark: SparkSession, kind: str, trees: list[Tree], bounds: list[np.ndarray]):
    """The trees as MLlib's model, by way of the format in which it stores one: a model of as many single leaves is saved, and its nodes are replaced."""
    jvm, gateway, name, here = spark._jvm, spark.sparkContext._gateway, *ENSEMBLES[kind]
    ml, one = jvm.org.apache.spark.ml, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    numbers = gateway.new_array(gateway.jvm.double, 3)
    leaf = ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(numbers, 0))
    array, weights = gateway.new_array(one, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i in range(len(trees)):
        array[i], weights[i] = one(f"tree_{uuid.uuid4().hex[:12]}", leaf, len(bounds)), 1.0
    uid = f"{kind}_{uuid.uuid4().hex[:12]}"
    model = ml.classification.GBTClassificationModel(uid, array, weights, len(bounds)) if kind == "boosting" else ml.regression.RandomForestRegressionModel(uid, array, len(bounds))
    if kind == "forest":
        model.set(model.getParam("numTrees"), len(trees))
    path = working_path(spark, "model")
    model.write().save(path)

    parts: dict[str, list] = {c: [] for c in ("tree", "id", "value", "left", "right", "feature", "threshold")}
    for k, t in enumerate(trees):
        left = np.array(t.left)
        inner = left > 0
        parts["tree"].append(np.full(len(left), k, np.int32))
        parts["id"].append(np.arange(len(left), dtype=np.int32))
        parts["value"].append(np.array(t.value, float))
        parts["left"].append(np.where(inner, left, -1).astype(np.int32))
        parts["right"].append(np.where(inner, left + 1, -1).astype(np.int32))
        parts["feature"].append(np.where(inner, t.feature, -1).astype(np.int32))
        parts["threshold"].append(np.array([float(bounds[f][c]) if i else 0.0 for f, c, i in zip(t.feature, t.cut, inner)]))
    nodes = spark.createDataFrame(pa.table({c: np.concatenate(v) for c, v in parts.items()}))
    inner = F.col("left") >= 0
    split = F.struct(
        F.col("feature").alias("featureIndex"), F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"))
    data = F.struct(
        "id", F.col("value").alias("prediction"), F.lit(0.0).alias("impurity"), F.array(*[F.lit(0.0)] * 3).alias("impurityStats"), F.lit(0).cast("long").alias("rawCount"),
        F.when(inner, 0.0).otherwise(-1.0).alias("gain"), F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"))
    nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    loaded = here.load(path)
    discard(spark, path)
    return loaded
