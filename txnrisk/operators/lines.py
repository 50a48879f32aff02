"""Binned features packed into few columns of codes ("lines"), without loss.

Features of two bins of which no row has more than one in its second bin share a bundle (the columns of a one-hot encoding do), and small bundles
share a line, whose code is their mixed-radix number.  Sums per code of a line give the sums per (feature, bin) of all its features, and a split of a
feature is a table over codes.  So rows are stored in fewer bytes and summed line by line, not feature by feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

MAX_CODES = 1 << 10      # of a line that holds several bundles
ALONE = 32               # bundles with more values have a line of their own
MAX_BUNDLE = 255
CHUNK = 1 << 16          # rows summed at a time


@dataclass
class Lines:
    """``sizes``: bins per feature; ``held``: features by line and bundle (features of one bin are in none)."""

    sizes: list[int]
    held: list[list[list[int]]]

    def __post_init__(self) -> None:
        self.shapes = [[self.sizes[b[0]] if len(b) == 1 else len(b) + 1 for b in line] for line in self.held]
        self.codes = [math.prod(s) for s in self.shapes]
        self.kinds = [np.dtype(np.uint8 if n <= 256 else np.uint16 if n <= 1 << 16 else np.uint32) for n in self.codes]
        self.place = {f: (i, k, j) for i, line in enumerate(self.held) for k, bundle in enumerate(line) for j, f in enumerate(bundle)}
        self.groups = [np.array(own, int) for own in ([f for f, n in enumerate(self.sizes) if n <= 2], [f for f, n in enumerate(self.sizes) if n > 2])]
        self.tables: dict[int, np.ndarray] = {}

    @property
    def row_bytes(self) -> int:
        return sum(k.itemsize for k in self.kinds)

    def pack(self, bins: np.ndarray) -> list[np.ndarray]:
        """A column of codes per line from ``bins``, which has a row per feature."""
        out = []
        for line, shape, kind in zip(self.held, self.shapes, self.kinds):
            code = np.zeros(bins.shape[1], kind)
            for bundle, size in zip(line, shape):
                digit = bins[bundle[0]] if len(bundle) == 1 else sum(bins[f] * np.uint8(j + 1) for j, f in enumerate(bundle))
                code = code * kind.type(size) + digit if len(line) > 1 else digit
            out.append(np.ascontiguousarray(code, kind))
        return out

    def split(self, cell: bytes, rows: int) -> list[np.ndarray]:
        """The columns from their bytes, one after another."""
        out, at = [], 0
        for kind in self.kinds:
            out.append(np.frombuffer(cell, kind, rows, at))
            at += rows * kind.itemsize
        return out

    def bins_of(self, feature: int) -> np.ndarray:
        """The bin of a feature by the code of its line."""
        if feature not in self.tables:
            line, k, j = self.place[feature]
            shape = self.shapes[line]
            digit = np.arange(self.codes[line]) // math.prod(shape[k + 1:]) % shape[k]
            self.tables[feature] = digit if len(self.held[line][k]) == 1 else (digit == j + 1).astype(digit.dtype)
        return self.tables[feature]

    def low(self, feature: int, cut: int) -> tuple[int, np.ndarray]:
        """A feature's line, and by code whether its bin is at most ``cut``."""
        return self.place[feature][0], self.bins_of(feature) <= cut

    def bundle_sums(self, line: int, k: int, sums: np.ndarray) -> np.ndarray:
        """Sums (..., value of a bundle) from those (..., code) of its line."""
        shape = self.shapes[line]
        if len(shape) == 1:
            return sums
        first, last = math.prod(shape[:k]), math.prod(shape[k + 1:])
        return sums.reshape(*sums.shape[:-1], first, shape[k], last).sum(axis=(-3, -1))

    def cells(self, sums: list[np.ndarray], total: np.ndarray) -> np.ndarray:
        """Sums (feature, bin, measure) from those (measure, code) of each line and of all rows."""
        out = np.zeros((len(self.sizes), max(self.sizes), len(total)), np.int64)
        out[:, 0] = total
        for i, line in enumerate(self.held):
            for k, bundle in enumerate(line):
                own = self.bundle_sums(i, k, sums[i]).T
                if len(bundle) == 1:
                    out[bundle[0], :len(own)] = own
                else:
                    out[bundle, 1] = own[1:]
                    out[bundle, 0] -= own[1:]
        return out


def planned(sizes: list[int], clash: np.ndarray) -> Lines:
    """Lines of features; ``clash[a, b]``: some row has both in the second bin, of two bins each."""
    bundles: list[list[int]] = []
    for f, n in enumerate(sizes):
        if n < 2:
            continue
        own = next((b for b in bundles if n == 2 and sizes[b[0]] == 2 and len(b) < MAX_BUNDLE and not clash[f, b].any()), None)
        if own is None:
            bundles.append([f])
        else:
            own.append(f)
    size = lambda b: sizes[b[0]] if len(b) == 1 else len(b) + 1
    held: list[list[list[int]]] = []
    for b in sorted(bundles, key=lambda b: (-size(b), b[0])):
        fits = (line for line in held if size(line[0]) <= ALONE and math.prod(size(x) for x in line) * size(b) <= MAX_CODES)
        line = next(fits, None)
        if line is None:
            held.append([b])
        else:
            line.append(b)
    return Lines(sizes, held)


def clash_task(sizes: list[int]):
    """Task over blocks of bins: which features of two bins some row has both in the second."""
    two = [f for f, n in enumerate(sizes) if n == 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros((len(two), len(two)), bool)
        for b in batches:
            for rows, cell in zip(b["rows"].to_pylist(), b["bins"]):
                bins = np.frombuffer(cell.as_buffer(), np.uint8).reshape(len(sizes), rows)
                for a in range(0, rows, CHUNK):  # counts below 2**24 are exact
                    ones = bins[two, a:a + CHUNK].astype(np.float32)
                    met |= ones @ ones.T > 0
        a, b = np.nonzero(np.triu(met, 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.array(two, np.int64)[x]) for x in (a, b)], names=["a", "b"])
    return run


def plan_of(blocks, sizes: list[int]) -> Lines:
    """The lines for a table of blocks (rows, bins)."""
    met = np.zeros((len(sizes), len(sizes)), bool)
    if sum(n == 2 for n in sizes) > 1:
        for r in blocks.select("rows", "bins").mapInArrow(clash_task(sizes), "a long, b long").distinct().collect():  # pairs of features at most
            met[r["a"], r["b"]] = met[r["b"], r["a"]] = True
    return planned(sizes, met)


def line_task(plan: Lines):
    """Task over blocks whose bins become codes of lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                rows, cell = one["rows"][0].as_py(), one["bins"][0].as_buffer()
                codes = plan.pack(np.frombuffer(cell, np.uint8).reshape(len(plan.sizes), rows))
                packed = pa.array([b"".join(c.tobytes() for c in codes)], pa.binary())
                yield one.set_column(one.schema.get_field_index("bins"), "bins", packed)
    return run


def line_sums(plan: Lines, codes: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None) -> list[np.ndarray]:
    """Sums ([g, h, n], code) of some rows, or of all, for every line; whole numbers, below 2**53 in a chunk."""
    out = [np.zeros((3, n), np.int64) for n in plan.codes]
    for a in range(0, len(g) if rows is None else len(rows), CHUNK):
        if rows is None:
            own, own_g, own_h = slice(a, a + CHUNK), g[a:a + CHUNK], h[a:a + CHUNK]
        else:
            own = rows[a:a + CHUNK].astype(np.intp)
            own_g, own_h = g.take(own), h.take(own)
        for sums, column, n in zip(out, codes, plan.codes):
            code = (column[own] if rows is None else column.take(own)).astype(np.intp)
            for s, x in zip(sums, (own_g, own_h, None)):
                s += np.bincount(code, x, n).astype(np.int64)
    return out


def parted_rows(column: np.ndarray, low: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rows`` whose code is in the table ``low``, and the others, in their order."""
    left, right = [], []
    for a in range(0, len(rows), CHUNK):
        own = rows[a:a + CHUNK]
        side = low.take(column.take(own.astype(np.intp)).astype(np.intp))
        left.append(own[np.flatnonzero(side)])
        right.append(own[np.flatnonzero(~side)])
    return np.concatenate(left), np.concatenate(right)
