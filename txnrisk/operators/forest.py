"""Random forests on binned rows, each tree on its own bootstrap sample with class weights of that sample.

A sample is a number of draws per row, Poisson with mean one, read off a hash of the row's key and the tree: no table of draws exists, and a recomputed task
draws the same.  ``balanced`` weighs a class by n / (2 * its draws) within each sample.  Trees minimise the weighted Gini impurity over the root of
the number of features, drawn anew at every node (more only where these allow no split).

A sample of at most ``LOCAL_ROWS`` rows is held by one task, in a few bytes a row (``lines``), which grows its tree.  Every such task reads the stored table and
draws for itself, so nothing is shuffled.  Trees of larger samples grow together, level by level.  Nodes with many rows get sums per (node, feature, bin) from one pass over the blocks, as many nodes at a time as
``MAX_CELLS`` allows, and of the features that a node draws; the others are summed only for nodes that these do not split.  The rows of a node of at most ``GROUP_ROWS`` meet in one group, which grows the subtree below it.  Sums and such rows travel in the
same pass, and the group of a node returns its split or its subtree.  Sums are whole numbers, so the forest does not depend on partitions.  The fitted model is MLlib's ``RandomForestRegressionModel`` (the mean of the trees' positive shares).
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.operators import kernels as K
from txnrisk.operators.boosting import (
    FIXED_POINT_BITS, LEAST_HESSIAN, ROUND_CONF, Leaf, Tree, as_batch, best_split, bin_bounds, histogram, packed, parted, stored_ensemble, unpacked,
)
from txnrisk.operators.lines import Lines, line_task, parted_rows, plan_of
from txnrisk.session import discard, working_path

MAX_BINS = 255
BLOCK_ROWS = 1 << 16
LOCAL_ROWS = 1 << 25     # of a sample whose tree is grown by one task: some 15 bytes each
GROUP_ROWS = 1 << 16     # of a node whose subtree is grown by one group
TASK_BYTES = 1 << 27     # of samples held by one task, if it has several
TASKS = 32               # that share the trees, at least
MAX_CELLS = 1 << 22      # sums a task holds in one pass
KEY = "row_key"
# A row is drawn k times where the top 32 bits of its hash lie between these numbers k - 1 and k: 2**32 * P(draws <= k).
DRAWS = [int(2**32 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(12)]


def tree_factor(tree: int, seed: int) -> int:
    """Odd 60-bit number that a row's key is multiplied with for one tree."""
    return int(hashlib.md5(f"tree-{tree}-{seed}".encode()).hexdigest()[:15], 16) | 1


def row_key(df: DataFrame) -> Column:
    """60-bit key of a row: from the transaction ID, or from all columns where there is none."""
    return K.portable_hash(F.lit("row"), F.col("txn_id")) if "txn_id" in df.columns else F.xxhash64(*df.columns).bitwiseAND((1 << 60) - 1)


def draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's sample."""
    top = ((key.astype(np.uint64) * np.uint64(tree_factor(tree, seed))) >> np.uint64(32)).astype(np.uint32)
    times = np.zeros(len(top), np.uint8)
    for least in DRAWS:  # a few comparisons of short numbers take less time than a search
        times += top >= np.uint32(least)
    return times.astype(np.int64)


def bootstrap_draws(df: DataFrame, trees: int = 250, seed: int = 42) -> DataFrame:
    """(txn_id, label, tree, draws) of every row in every tree's sample (absent: not drawn)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b[KEY].to_numpy(zero_copy_only=False)
            for t in range(trees):
                times = draws(key, t, seed)
                hit = pa.array(times > 0)
                n = int((times > 0).sum())
                yield pa.RecordBatch.from_arrays(
                    [b["txn_id"].filter(hit), b["label"].filter(hit), pa.array(np.full(n, t, np.int32)), pa.array(times[times > 0].astype(np.int64))], names=["txn_id", "label", "tree", "draws"])

    kinds = dict(df.dtypes)
    rows = df.select("txn_id", "label", row_key(df).alias(KEY))
    return rows.mapInArrow(run, f"txn_id {kinds['txn_id']}, label {kinds['label']}, tree int, draws long")


def bootstrap_weights(df: DataFrame, trees: int = 250, seed: int = 42) -> DataFrame:
    """(txn_id, label, tree, draws, weight): draws times the balanced class weight of the tree's own sample."""
    drawn = bootstrap_draws(df, trees, seed)
    per_class = drawn.groupBy("tree", "label").agg(F.sum("draws").alias("of_class"))
    total = per_class.groupBy("tree").agg(F.sum("of_class").alias("of_tree"))
    weights = per_class.join(total, "tree").select("tree", "label", (F.col("of_tree") / (2 * F.col("of_class"))).alias("class_weight"))
    return drawn.join(K.small(weights, 2 * trees), ["tree", "label"]).select("txn_id", "label", "tree", "draws", (F.col("draws") * F.col("class_weight")).alias("weight"))


# --------------------------------------------------------------------------- growing

def tried(order: np.ndarray, few: int) -> list[np.ndarray]:
    """Groups of features in the order a node tries them: the first ``few`` together, then one by one."""
    return [order[:few], *order[few:, None]]


def split_of(cells_of, leaf: Leaf, groups: list[np.ndarray], min_rows: int) -> tuple | None:
    """The best split over the first group of features that allows any.

    ``cells_of``: features -> their sums.
    """
    for group in groups:
        if found := best_split(cells_of(group), leaf, min_rows, 0.0):
            gain, feature, cut, left, right = found
            return gain, int(group[feature]), cut, left, right
    return None


def feature_order(width: int, seed: int, tree: int, place: int) -> np.ndarray:
    """The features in the order a node tries them; ``place`` is 1 for the root, 2p and 2p + 1 for the children of p."""
    return np.random.default_rng([seed, tree, place]).permutation(width)


def mixed(leaf: Leaf) -> bool:
    return 0 < leaf.g < leaf.h


def grow_rows(bins: np.ndarray, g: np.ndarray, h: np.ndarray, scale: float, tree: int, place: int, forest: HistogramForest) -> list[tuple]:
    """Splits of some rows' subtree: (node, feature, cut, left sums, right sums); node 0 are all rows, split k has children 2k+1 and 2k+2."""
    out, units = [], np.array([scale, scale, 1.0])
    open_nodes = [(0, np.arange(len(g)), place, Leaf(g.sum() / scale, h.sum() / scale, len(g)))]
    while open_nodes:
        node, rows, at, leaf = open_nodes.pop()
        if at.bit_length() > forest.depth or leaf.n < 2 * forest.min_rows or not mixed(leaf):
            continue
        own_g, own_h = g[rows], h[rows]

        def cells(features: np.ndarray) -> np.ndarray:
            own = np.stack([bins[f][rows] for f in features])
            return histogram(own, own_g, own_h, int(own.max()) + 1) / units

        found = split_of(cells, leaf, tried(feature_order(len(bins), forest.seed, tree, at), forest.few(len(bins))), forest.min_rows)
        if found is None:
            continue
        _, feature, cut, left, right = found
        child, low = 2 * len(out) + 1, bins[feature][rows] <= cut
        out.append((node, feature, cut, *left, *right))
        open_nodes += [(child, rows[low], 2 * at, Leaf(*left)), (child + 1, rows[~low], 2 * at + 1, Leaf(*right))]
    return out


# Of a drawn row, by draws + 16 * label: one, the draws of a negative and the draws of a positive as parts of one whole number, whose sums over CHUNK rows stay apart.
CHUNK = 1 << 14
PARTS_OF = np.array([1 + t * (1 << 33 if y else 1 << 15) for y in (0, 1) for t in range(16)], float)


def weights_of(weights: list[float], scale: float) -> np.ndarray:
    """Fixed-point weight of a row by draws + 16 * label."""
    return np.concatenate([np.rint(np.arange(16) * w * scale) for w in weights])


def drawn_sums(codes: list[np.ndarray], sizes: list[int], drawn: np.ndarray, rows: np.ndarray, unit: np.ndarray) -> list[np.ndarray]:
    """Sums ([weight of positives, weight, rows], code) of some rows by columns of codes; ``unit``: weight by ``drawn``."""
    out = [np.zeros((3, n), np.int64) for n in sizes]
    # Draws are counted, not weights, where a weight is a number of draws times that of one.
    counted = all((unit[k:k + 16] == np.arange(16) * unit[k + 1]).all() for k in (0, 16))
    positive = np.where(np.arange(32) < 16, 0.0, unit)
    for a in range(0, len(rows), CHUNK):
        own = rows[a:a + CHUNK].astype(np.intp)
        kinds = drawn.take(own).astype(np.intp)
        parts = [PARTS_OF.take(kinds)] if counted else [positive.take(kinds), unit.take(kinds), None]
        for sums, column, n in zip(out, codes, sizes):
            code = column.take(own).astype(np.intp)
            found = [np.bincount(code, x, n).astype(np.int64) for x in parts]
            if counted:
                found = [found[0] >> 33, found[0] >> 15 & 0x3FFFF, found[0] & 0x7FFF]
            for s, x in zip(sums, found):
                s += x
    if counted:
        for sums in out:
            sums[0] *= int(unit[17])
            sums[1] = sums[0] + sums[1] * int(unit[1])
    return out


def best_cut(below: np.ndarray, leaf: Leaf, min_rows: int, scale: float) -> tuple | None:
    """The first of the cuts with the largest gain, from sums below each: as ``best_split`` without a penalty."""
    g, h, n = below[0] / scale, below[1] / scale, below[2]
    rg, rh, rn = leaf.g - g, leaf.h - h, leaf.n - n
    allowed = (n >= min_rows) & (rn >= min_rows) & (h >= LEAST_HESSIAN) & (rh >= LEAST_HESSIAN)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, g * g / h + rg * rg / rh - leaf.g**2 / leaf.h, -np.inf)
    at = int(np.argmax(gain))
    if not gain[at] > 0:
        return None
    return at, (float(g[at]), float(h[at]), int(n[at])), (float(rg[at]), float(rh[at]), int(rn[at]))


def grow_sample(plan: Lines, codes: list[np.ndarray], drawn: np.ndarray, unit: np.ndarray, scale: float, tree: int, forest: HistogramForest) -> Tree:
    """The tree of one sample; ``drawn``: draws + 16 * label of every row."""
    count = np.bincount(drawn, minlength=32)
    root = Leaf(float(count[16:] @ unit[16:]) / scale, float(count @ unit) / scale, len(drawn))
    width, out = len(plan.sizes), Tree(value=[root.g / root.h if root.h else 0.0])
    open_nodes = [(0, np.arange(len(drawn), dtype=np.int32), 1, root)]
    while open_nodes:
        node, rows, at, leaf = open_nodes.pop()
        if at.bit_length() > forest.depth or leaf.n < 2 * forest.min_rows or not mixed(leaf):
            continue
        for group in tried(feature_order(width, forest.seed, tree, at), forest.few(width)):
            own = [f for f in group.tolist() if f in plan.place]
            lines = sorted({plan.place[f][0] for f in own})
            sums = dict(zip(lines, drawn_sums([codes[i] for i in lines], [plan.codes[i] for i in lines], drawn, rows, unit)))
            bundles = {b: plan.bundle_sums(*b, sums[b[0]]) for b in {plan.place[f][:2] for f in own}}
            below = []
            for f in own:
                line, k, j = plan.place[f]
                values = bundles[line, k]
                below.append(values.cumsum(axis=1)[:, :-1] if len(plan.held[line][k]) == 1 else values.sum(axis=1, keepdims=True) - values[:, j + 1:j + 2])
            found = best_cut(np.concatenate(below, axis=1), leaf, forest.min_rows, scale) if own else None
            if found:
                break
        else:
            continue
        cut, left, right = found
        for f, cuts in zip(own, below):
            if cut < cuts.shape[1]:
                break
            cut -= cuts.shape[1]
        children = out.divide(node, f, cut)
        line, low = plan.low(f, cut)
        for child, part, place, (g, h, n) in zip(children, parted_rows(codes[line], low, rows), (2 * at, 2 * at + 1), (left, right)):
            out.value[child] = g / h if h else 0.0
            open_nodes.append((child, part, place, Leaf(g, h, n)))
    return out


# --------------------------------------------------------------------------- blocks

BLOCKS_DDL = "rows long, bins binary, label binary, key binary"
BLOCKS = pa.schema([("rows", pa.int64()), *((c, pa.binary()) for c in ("bins", "label", "key"))])


def block_task(bounds: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def block() -> pa.RecordBatch:
            x, y, key = (np.concatenate(c) for c in zip(*held))
            bins = np.stack([np.searchsorted(b, x[:, j]).astype(np.uint8) for j, b in enumerate(bounds)])
            cells = [len(y), bins.tobytes(), y.astype(np.uint8).tobytes(), key.astype("<i8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, BLOCKS)], schema=BLOCKS)

        for b in batches:
            if b.num_rows:
                x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                held.append((x, b["label"].to_numpy(zero_copy_only=False), b[KEY].to_numpy(zero_copy_only=False)))
                rows += b.num_rows
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
        if held:
            yield block()
    return run


def opened(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for cells in b.to_pylist():
            yield np.frombuffer(cells["bins"], np.uint8).reshape(width, cells["rows"]), np.frombuffer(cells["label"], np.uint8), np.frombuffer(cells["key"], "<i8")


def sample_task(width: int, trees: int, seed: int):
    """Task over blocks: draws and drawn rows of either class per tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((trees, 2, 2), np.int64)
        for _, label, key in opened(batches, width):
            for t in range(trees):
                found = np.bincount(draws(key, t, seed) + 16 * label, minlength=32).reshape(2, 16)
                total[t] += np.stack([found @ np.arange(16), found[:, 1:].sum(axis=1)], axis=1)
        t, c = (x.ravel() for x in np.indices((trees, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(c), *(pa.array(total[..., k].ravel()) for k in (0, 1))], names=["tree", "label", "draws", "rows"])
    return run


SAMPLES_DDL = "tree long, label long, draws long, rows long"


def slopes(label: np.ndarray, times: np.ndarray, weights: list[float], scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point weight of the positive class, and of both, of every row."""
    h = np.rint(times * np.where(label == 1, weights[1], weights[0]) * scale)
    return np.where(label == 1, h, 0.0), h


TREES = pa.schema([("tree", pa.int64()), *((c, pa.binary()) for c in ("feature", "cut", "left", "value"))])
TREES_DDL = "tree long, feature binary, cut binary, left binary, value binary"


def trees_task(plan: Lines, groups: list[list[int]], weights: dict[int, list[float]], scale: float, forest: HistogramForest):
    """Task over all blocks of codes: the trees of the group with the number of its partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = groups[TaskContext.get().partitionId()]
        held: dict[int, list[list[np.ndarray]]] = {t: [[] for _ in (*plan.held, "drawn")] for t in own}
        for b in batches:
            for cells in b.to_pylist():
                columns = plan.split(cells["bins"], cells["rows"])
                label, key = np.frombuffer(cells["label"], np.uint8), np.frombuffer(cells["key"], "<i8")
                for t in own:
                    times = draws(key, t, forest.seed).astype(np.uint8)
                    rows = np.flatnonzero(times)
                    for part, c in zip(held[t], (*columns, times + 16 * label)):
                        part.append(c.take(rows))
        for t in own:
            columns = held.pop(t)
            for k, part in enumerate(columns):
                columns[k] = np.concatenate(part)
            tree = grow_sample(plan, columns[:-1], columns[-1], weights_of(weights[t], scale), scale, t, forest)
            cells = [np.array(x, kind).tobytes() for x, kind in ((tree.feature, np.int64), (tree.cut, np.int64), (tree.left, np.int64), (tree.value, float))]
            yield as_batch([(t, *cells)], TREES)
    return run


# Of some rows of a node: bins, labels and draws; or, without bins, sums per cell.
PARTS_DDL = "tree long, node long, bins binary, label binary, times binary, g binary, h binary, n binary"
PARTS = pa.schema([("tree", pa.int64()), ("node", pa.int64()), *((c, pa.binary()) for c in ("bins", "label", "times", "g", "h", "n"))])


def pass_task(
    width: int, sizes: list[int], trees: dict[int, Tree], features: dict[tuple[int, int], np.ndarray], few: list[tuple[int, int]], weights: dict[int, list[float]], scale: float, seed: int,
):
    """Task over blocks: sums of the nodes in ``features`` by features of their own, the sampled rows of the nodes in ``few``."""
    nodes: dict[int, set[int]] = {}
    for t, n in (*features, *few):
        nodes.setdefault(t, set()).add(n)
    inner = {t: trees[t].inner(wanted) for t, wanted in nodes.items()}
    few_at, own_weights = set(few), {t: weights[t] for t in nodes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for bins, label, key in opened(batches, width):
            for t, wanted in nodes.items():
                times, out = draws(key, t, seed), []
                for n, rows in parted(bins, inner[t], wanted, np.flatnonzero(times)):
                    if not len(rows):
                        continue
                    if (t, n) in few_at:
                        out.append((t, n, bins[:, rows].tobytes(), label[rows].tobytes(), times[rows].astype(np.uint8).tobytes(), None, None, None))
                        continue
                    own = features[t, n]
                    sums = packed((bins[f][rows] for f in own), (sizes[f] for f in own), *slopes(label[rows], times[rows], own_weights[t], scale))
                    total[t, n] = total[t, n] + sums if (t, n) in total else sums
                if out:
                    yield as_batch(out, PARTS)
        done = [(*k, None, None, None, *(x.tobytes() for x in sums)) for k, sums in total.items()]
        for a in range(0, len(done), 64):
            yield as_batch(done[a:a + 64], PARTS)
    return run


SPLITS = pa.schema([(c, pa.float64() if c in ("lg", "lh", "rg", "rh") else pa.int64()) for c in ("tree", "root", "node", "feature", "cut", "lg", "lh", "ln", "rg", "rh", "rn")])
SPLITS_DDL = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double'}" for f in SPLITS)


def settle_task(
    width: int, sizes: list[int], features: dict[tuple[int, int], np.ndarray], sums_of: dict[tuple[int, int], tuple], together: int, places: dict[tuple[int, int], int],
    weights: dict[int, list[float]], scale: float, forest: HistogramForest,
):
    """Task over what was sent of one node: its best split from sums (the first ``together`` features first, then one by one), its subtree from rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, at = [], None, None
        for b in batches:
            for part in b.to_pylist():
                at = part["tree"], part["node"]
                if part["bins"] is not None:
                    rows.append(part)
                else:
                    sums = np.stack([np.frombuffer(part[c], np.int64) for c in "ghn"])
                    total = sums if total is None else total + sums
        if rows:
            label, times = (np.frombuffer(b"".join(p[c] for p in rows), np.uint8) for c in ("label", "times"))
            bins = np.concatenate([np.frombuffer(p["bins"], np.uint8).reshape(width, -1) for p in rows], axis=1)
            splits = [(*at, *s) for s in grow_rows(bins, *slopes(label, times, weights[at[0]], scale), scale, at[0], places[at], forest)]
        else:
            own = features[at]
            cells = unpacked(total, [sizes[f] for f in own]) / np.array([scale, scale, 1.0])
            found = split_of(lambda f: cells[f], Leaf(*sums_of[at]), [g for g in tried(np.arange(len(own)), together) if len(g)], forest.min_rows)
            splits = [(*at, 0, int(own[found[1]]), found[2], *found[3], *found[4])] if found else []
        yield as_batch(splits, SPLITS)
    return run


# --------------------------------------------------------------------------- scoring

def node_tables(trees: list[Tree], bounds: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per tree: feature, threshold, left child (the right one follows; a leaf's is itself) and value by node, and its depth."""
    out = []
    for t in trees:
        left = np.array(t.left)
        inner, depth, level = left > 0, 0, np.zeros(1, int)
        while len(level := left[level[inner[level]]]):
            level, depth = np.concatenate([level, level + 1]), depth + 1
        limits = np.array([float(bounds[f][c]) if i else np.inf for f, c, i in zip(t.feature, t.cut, inner)])
        out.append((np.where(inner, t.feature, 0).astype(np.int16 if len(bounds) < 1 << 15 else np.int32), limits, np.where(inner, left, np.arange(len(left))).astype(np.int32), np.array(t.value, float), depth))
    return out


SCORED_ROWS = 1 << 11    # whose features a core's cache holds


def mean_of_trees(x: np.ndarray, tables: list[tuple]) -> np.ndarray:
    """The mean of the trees' values for the rows of a matrix, tree by tree: the same sums in the same order as MLlib's model."""
    out = np.zeros(len(x))
    wide = [(f.astype(np.intp), limit, left.astype(np.intp), value, depth) for f, limit, left, value, depth in tables]
    for a in range(0, len(x), SCORED_ROWS):
        part = np.ascontiguousarray(x[a:a + SCORED_ROWS].T)
        part[np.isnan(part)] = np.inf  # goes right
        flat, n = part.ravel(), part.shape[1]
        own = np.arange(n)
        for feature, limit, left, value, depth in wide:
            node = np.zeros(n, np.intp)
            for _ in range(depth):
                node = left.take(node) + (flat.take(feature.take(node) * n + own) > limit.take(node))
            out[a:a + n] += value.take(node)
    return out / len(tables)


def scored(df: DataFrame, tables: list[tuple], features: str = "features") -> Column:
    """Score by ``tables`` of a vector column."""
    shared = df.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("double")
    def mean(x: pd.Series) -> pd.Series:
        return pd.Series(mean_of_trees(np.vstack(x.to_numpy()), shared.value) if len(x) else [], dtype=float)

    return mean(vector_to_array(features))


# --------------------------------------------------------------------------- fitting

@dataclass
class HistogramForest:
    """Estimator over ``features``, ``label`` (0/1) and the row keys."""

    trees: int = 250
    depth: int = 10
    min_rows: int = 8
    balanced: bool = False
    seed: int = 42
    features: str = "features"
    label: str = "label"
    bounds: list[np.ndarray] | None = None  # of bins, if known

    def copy(self) -> HistogramForest:
        return HistogramForest(**vars(self))

    def setFeaturesCol(self, name: str) -> HistogramForest:  # noqa: N802 (MLlib's names)
        self.features = name
        return self

    def setLabelCol(self, name: str) -> HistogramForest:  # noqa: N802
        self.label = name
        return self

    def few(self, width: int) -> int:
        return max(1, math.isqrt(width))

    def fit(self, df: DataFrame) -> RandomForestRegressionModel:
        bounds, trees = self.grow(df)
        model = stored_ensemble(df.sparkSession, "forest", trees, bounds)
        model.tables = node_tables(trees, bounds)  # for scoring here; a model that was loaded scores by itself
        return model

    def grow(self, df: DataFrame) -> tuple[list[np.ndarray], list[Tree]]:
        keyed = df if KEY in df.columns else df.withColumn(KEY, row_key(df))
        rows = keyed.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("long").alias("label"), KEY)
        one = rows.agg(F.count(F.lit(1)).alias("n"), F.first(F.size("x"), ignorenulls=True).alias("width")).first()
        if not one["n"]:
            raise ValueError("No rows to learn from.")
        width = one["width"]
        bounds = bin_bounds(rows, width, MAX_BINS) if self.bounds is None else self.bounds
        spark, rounds = df.sparkSession, df.sparkSession.newSession()
        for key, value in {**ROUND_CONF, "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.unionOutputPartitioning": "false"}.items():
            rounds.conf.set(key, value)  # subtrees are worth as many reducers as the caller's own shuffles
        path = working_path(spark, "forest-blocks")
        rows.mapInArrow(block_task(bounds), BLOCKS_DDL).write.parquet(path)
        trees = self.grown(rounds.read.schema(BLOCKS_DDL).parquet(path), [len(b) + 1 for b in bounds], one["n"])
        discard(spark, path)
        return bounds, trees

    def one_by_one(self, blocks: DataFrame, sizes: list[int], weights: dict[int, list[float]], roots: dict[int, Leaf], scale: float) -> list[Tree]:
        """Every tree grown by one task, which reads all blocks; a task has several trees where samples are small."""
        spark, plan = blocks.sparkSession, plan_of(blocks, sizes)
        path = working_path(spark, "forest-lines")
        blocks.mapInArrow(line_task(plan), BLOCKS_DDL).write.parquet(path)
        most = max(r.n for r in roots.values())
        together = max(1, min(TASK_BYTES // (max(1, most) * (plan.row_bytes + 1)), self.trees // TASKS))
        groups = [list(range(a, min(self.trees, a + together))) for a in range(0, self.trees, together)]
        whole = spark.read.schema(BLOCKS_DDL).parquet(path).coalesce(1)
        task = trees_task(plan, groups, weights, scale, self)
        grown = functools.reduce(DataFrame.unionAll, [whole] * len(groups)).mapInArrow(task, TREES_DDL).toArrow().to_pylist()
        discard(spark, path)
        out = {r["tree"]: Tree(*(np.frombuffer(r[c], kind).tolist() for c, kind in (("feature", np.int64), ("cut", np.int64), ("left", np.int64), ("value", float)))) for r in grown}
        return [out[t] for t in range(self.trees)]

    def samples(self, blocks: DataFrame, width: int) -> tuple[dict[int, list[float]], dict[int, Leaf]]:
        """Class weights and root of every tree's sample."""
        found = blocks.mapInArrow(sample_task(width, self.trees, self.seed), SAMPLES_DDL).groupBy("tree", "label").agg(F.sum("draws").alias("draws"), F.sum("rows").alias("rows")).collect()
        drawn = {(r["tree"], r["label"]): (r["draws"], r["rows"]) for r in found}
        weights, roots = {}, {}
        for t in range(self.trees):
            n = [drawn[t, c][0] for c in (0, 1)]
            weights[t] = [sum(n) / (2 * k) if k else 0.0 for k in n] if self.balanced else [1.0, 1.0]
            g, h = n[1] * weights[t][1], n[0] * weights[t][0] + n[1] * weights[t][1]
            roots[t] = Leaf(g, h, drawn[t, 0][1] + drawn[t, 1][1])
        return weights, roots

    def sums(
        self, blocks: DataFrame, sizes: list[int], trees: dict[int, Tree], features: dict[tuple[int, int], np.ndarray], weights: dict[int, list[float]], scale: float,
        few: list[tuple[int, int]], known: dict[tuple[int, int], tuple[Leaf, int]], together: int,
    ) -> pa.Table:
        """Splits from one pass over the blocks: of the nodes in ``features`` from sums, of all below those in ``few`` from their rows."""
        sums_of = {k: (known[k][0].g, known[k][0].h, known[k][0].n) for k in features}
        parts = blocks.mapInArrow(pass_task(len(sizes), sizes, trees, features, few, weights, scale, self.seed), PARTS_DDL)
        task = settle_task(len(sizes), sizes, features, sums_of, together, {k: known[k][1] for k in few}, weights, scale, self)
        return parts.groupBy("tree", "node").applyInArrow(task, SPLITS_DDL).toArrow()  # at most trees x 2**depth

    def grown(self, blocks: DataFrame, sizes: list[int], rows: int) -> list[Tree]:
        width = len(sizes)
        weights, leaves = self.samples(blocks, width)
        most = max(max(w) for w in weights.values())
        scale = 2.0 ** min(FIXED_POINT_BITS, 61 - math.ceil(math.log2(max(1.0, 12 * rows * most))))
        if max(leaf.n for leaf in leaves.values()) <= LOCAL_ROWS:
            return self.one_by_one(blocks, sizes, weights, leaves, scale)
        trees = {t: Tree() for t in range(self.trees)}
        # (tree, node) -> sums and place, of open nodes alone: all trees' nodes would be hundreds of MB in the driver.
        known = {(t, 0): (leaf, 1) for t, leaf in leaves.items()}
        open_nodes = list(known)

        def share(g: float, h: float) -> float:
            return g / h if h else 0.0

        def divide(t: int, node: int, feature: int, cut: int, left: tuple, right: tuple) -> tuple[int, int]:
            children = trees[t].divide(node, feature, cut)
            for child, (g, h, _) in zip(children, (left, right)):
                trees[t].value[child] = share(g, h)
            return children

        for t, leaf in leaves.items():
            trees[t].value[0] = share(leaf.g, leaf.h)
        while open_nodes:
            worth = [k for k in open_nodes if known[k][0].n >= 2 * self.min_rows and mixed(known[k][0]) and known[k][1].bit_length() <= self.depth]
            many = [k for k in worth if known[k][0].n > min(LOCAL_ROWS, GROUP_ROWS)]
            few = [k for k in worth if known[k][0].n <= min(LOCAL_ROWS, GROUP_ROWS)]
            splits, enough = [], self.few(width)
            for lo, hi in ((0, enough), (enough, width)):  # nodes that their first features do not split try the others
                at_once, waiting, many = max(1, MAX_CELLS // (max(1, hi - lo) * 256)), many if hi > lo else [], []
                for a in range(0, max(len(waiting), bool(few)), at_once):
                    features = {k: feature_order(width, self.seed, k[0], known[k][1])[lo:hi] for k in waiting[a:a + at_once]}
                    grown = self.sums(blocks, sizes, trees, features, weights, scale, few, known, 0 if lo else enough)
                    few, subtree, names, count, settled = [], None, {}, 0, set()  # rows travel in the first pass
                    for batch in grown.to_batches(max_chunksize=4096):  # a node's rows follow each other
                        for t, root, node, feature, cut, lg, lh, ln, rg, rh, rn in zip(*(batch[c].to_pylist() for c in SPLITS.names)):
                            if (t, root) in features:
                                splits.append((t, root, feature, cut, (lg, lh, ln), (rg, rh, rn)))
                                settled.add((t, root))
                                continue
                            if subtree != (t, root):
                                subtree, names, count = (t, root), {0: root}, 0
                            children = divide(t, names[node], feature, cut, (lg, lh, ln), (rg, rh, rn))
                            names.update({2 * count + 1: children[0], 2 * count + 2: children[1]})
                            count += 1
                    if not lo:
                        many += [k for k in features if k not in settled]
            places = {(t, n): known[t, n][1] for t, n, *_ in splits}
            known = {}
            for t, n, feature, cut, left, right in splits:
                children = divide(t, n, feature, cut, left, right)
                known.update({(t, c): (Leaf(*sums), 2 * places[t, n] + k) for k, (c, sums) in enumerate(zip(children, (left, right)))})
            open_nodes = list(known)
        return [trees[t] for t in range(self.trees)]
