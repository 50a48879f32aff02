"""Exact substring deduplication over bytes: maximal repeats from the interval tree of an enhanced suffix array.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in another document or
in its own; occurrences may overlap, every occurrence is removed, and strings are judged on the input.

The windows of ``LENGTH`` bytes are dealt to buckets by their minimiser (``superkmers``), an anchor that equal windows hold at the
same offset.  So a bucket needs one suffix per segment, the one that starts at the anchor: two occurrences of a
repeat are aligned there.  The bucket sorts these suffixes and takes the common prefix of each with the next; scanning
that array with a stack yields the interval tree: every node is a set of suffixes and the longest prefix they all share,
diverse to the right.  Within a node, the texts to the left of the anchors are sorted and scanned in the same way: every
node of that scan is diverse to the left.  A pair of nodes whose common left and right parts make at least ``LENGTH`` bytes is a
maximal repeat, and the group holds all its occurrences, not only neighbours in the array.

A passage shorter than ``LENGTH`` that very many documents hold gives all of them the same minimiser, with other bytes around it.  The bytes
that travel are therefore summed by minimiser first, and too large groups are divided by further bytes at fixed places around
the anchor (``divided``), again and again down to whole windows, before anything is sent.

Null texts count as empty.  Rows may repeat an ID or lack one: each is judged by itself, and equal texts in different rows do
repeat each other.  Matches never cross documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import superkmers as S
from txnrisk.llm.substring import answer, received, send, with_spans

LENGTH = 400
GRAM = 32
MAX_BUCKETS = 1 << 20
LARGE_SHARE = 0.25  # share of a bucket above which the segments of one key are divided
BLOCK = 8_000  # rows of context compared at a time
HASH_BLOCK = 1 << 14  # positions hashed at a time, so that a core's cache holds the steps between


def pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[S.Piece]:
    """Documents of at least ``length`` bytes; long ones in parts that overlap by ``length`` less one."""
    for b in batches:
        for row, mark, text in zip(b["row_id"].to_pylist(), b["mark"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
            step = S.CHUNK_BYTES if len(text) > 2 * S.CHUNK_BYTES else len(text)
            for base in range(0, max(0, len(text) - length + 1), max(1, step)):
                part = text[base:base + step + length - 1]
                yield S.Piece(row, mark, base, len(part), part)


def grams_of(held: list[S.Piece], gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's bytes and the hash of the ``gram`` bytes from every position on, eight at a time, block by block."""
    data = np.frombuffer(b"".join(p.data for p in held), np.uint8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data), "<u8", padded, strides=(1,))  # the eight bytes from every position on, overlapping
    n = max(0, len(data) - gram + 1)
    grams = np.empty(n, np.uint64)
    for at in range(0, n, HASH_BLOCK):
        size = min(HASH_BLOCK, n - at)
        words = eight[at:at + size + (gram - 1) // 8 * 8].astype(np.uint64)
        block = words[:size]
        for k in range(8, gram, 8):
            block = S.join_hashes(block, words[k:k + size])
        grams[at:at + size] = S.mix(block)
    return data, grams


def grids(length: int) -> list[int]:
    """Steps of the grids by which too large groups are divided, one finer than the other; the last one divides by whole windows."""
    return sorted({max(1, length // 8), max(1, length // 50), 1}, reverse=True)


def divided(found: S.Segments, length: int, grid: int, ranges: S.RangeHash) -> S.Segments:
    """Each segment as one or more that together hold its windows, with keys in place of the minimiser that tell more texts apart.

    The anchor stands on a grid.  Windows that start within the same step before it hold the same ``length - grid + 1`` bytes from a grid point
    on; that point and the hash of these bytes are added to the key.  Equal windows hold the anchor at the same offset, so they still meet.
    """
    windows = found.size - length + 1
    low = (found.anchor - windows + 1) // grid
    steps = found.anchor // grid - low + 1
    owner = np.repeat(np.arange(len(steps)), steps)
    step = S.expand(low, steps)
    anchor = found.anchor[owner].astype(np.int64)
    most = np.minimum(step * grid + grid - 1, anchor)  # offsets of the anchor in the windows
    least = np.maximum(step * grid, anchor - windows[owner] + 1)
    size, first = most - least + length, anchor - most
    block = found.at[owner] + anchor - step * grid
    key = S.join_hashes(S.join_hashes(found.minimiser[owner], step.astype(np.uint64)), ranges(block, block + length - grid + 1))
    return S.Segments(found.row[owner], found.mark[owner], found.start[owner] + first, size, most, key, found.at[owner] + first, size, found.data)


def segments_of(batches: Iterator[pa.RecordBatch], length: int, gram: int, hot: np.ndarray, too_large: list[np.ndarray]) -> Iterator[tuple[S.Segments, np.ndarray]]:
    """Segments of each chunk and the hashes of their texts.  Those of the keys in ``too_large``, one list per grid, are divided."""
    for held in S.chunks(pieces(batches, length)):
        data, grams = grams_of(held, gram)
        ends = np.cumsum([p.units for p in held])
        valid = np.ones(len(data), bool)
        for e in ends.tolist():
            valid[max(0, e - length + 1):e] = False
        first, last, where = S.runs(grams, hot, length - gram + 1, valid)
        whose = np.searchsorted(ends, first, side="right")
        row, mark, base = (np.array([getattr(p, f) for p in held])[whose] for f in ("row", "mark", "base"))
        size = last + length - first
        origin = np.concatenate([[0], ends[:-1]])[whose]
        found = S.Segments(
            row.astype(np.int64), mark.astype(np.int32), first - origin + base, size, where - first, grams[where], first, size, data,
        )
        ranges = S.RangeHash(data)
        for grid, keys in zip(grids(length), too_large):
            large = np.isin(found.minimiser, keys)
            if large.any():
                found = found.take(np.flatnonzero(~large)).joined(divided(found.take(np.flatnonzero(large)), length, grid, ranges))
        yield found, ranges(found.at, found.at + found.size)


def segment_task(length: int, gram: int, hot: np.ndarray, buckets: int, too_large: list[np.ndarray] = []):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, hashes in segments_of(batches, length, gram, hot, too_large):
            yield from send(found, hashes, buckets, keep_smallest=False)
    return run


def large_keys(rows: DataFrame, length: int, gram: int, hot: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Per grid, the keys whose segments would bring more than ``LARGE_SHARE`` of a bucket, and the bytes that dividing adds.

    The bytes that travel are summed by key, exactly.  A key in a finer grid is counted only below one that is too large; what
    is left after the last one are equal windows, of which a chunk sends one.
    """
    too_large, added = [], 0
    limit = int(LARGE_SHARE * S.BUCKET_BYTES)
    for _ in grids(length):
        above = too_large[-1] if too_large else None

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found, hashes in segments_of(batches, length, gram, hot, too_large[:-1]):
                if above is not None:
                    some = np.flatnonzero(np.isin(found.minimiser, above))
                    found = divided(found.take(some), length, grids(length)[len(too_large) - 1], ranges := S.RangeHash(found.data))
                    hashes = ranges(found.at, found.at + found.size)
                if not len(found.row):
                    continue
                order, group = S.local_groups(found, hashes)
                travels = order[np.concatenate([[True], np.diff(group) != 0])]
                keys, where = np.unique(found.minimiser[travels], return_inverse=True)
                size = np.bincount(where, found.size[travels]).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": size})

        counted = rows.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
        if not counted:
            break
        too_large.append(np.sort(np.array([r["key"] for r in counted], np.int64).view(np.uint64)))
        step, finer = [length, *grids(length)][len(too_large) - 1:][:2]
        added += math.ceil(step / finer) * sum(r["n"] for r in counted)
    return too_large, added


# ------------------------------------------------------------- the enhanced suffix array of a bucket

def contexts(segments: S.Segments, group: np.ndarray, left: bool, length: int) -> np.ndarray:
    """Per segment, a row of numbers that sorts like its text from the anchor on (or, ``left``, backwards from it).

    Bytes are raised by one, so that the zeros behind the text sort below any byte; the first two numbers are the group.
    """
    n = segments.anchor.astype(np.int64) if left else segments.size - segments.anchor
    width = int(n.max(initial=0))
    out = np.zeros((len(n), width + 2), ">u2")
    out[:, 0], out[:, 1] = group // 65_000 + 1, group % 65_000 + 1
    owner = np.repeat(np.arange(len(n)), n)
    column = S.expand(np.zeros(len(n), np.int64), n)
    anchor = (segments.at + segments.anchor)[owner]
    out[owner, column + 2] = segments.data[anchor - 1 - column if left else anchor + column].astype(np.uint16) + 1
    return out


def sort_rows(rows: np.ndarray) -> np.ndarray:
    """Order of the rows, number by number."""
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1] * 2}").ravel(), kind="stable")


def shared(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows ``a`` and ``b``, group numbers and padding not counted; -1 across groups."""
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), BLOCK):
        x, y = rows[a[at:at + BLOCK]], rows[b[at:at + BLOCK]]
        differ = (x != y) | (x == 0)
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[at:at + BLOCK] = np.where((x[:, :2] == y[:, :2]).all(axis=1), first - 2, -1)
    return out


def intervals(depth: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Nodes of the interval tree over neighbours' common prefixes: rows (first, last, depth), depth at least ``least`` there.

    One scan with a stack: a deeper prefix opens a node, a shallower one closes all deeper nodes.
    """
    out: list[tuple[int, int, int]] = []
    open_first: list[int] = []
    open_depth: list[int] = []
    for i, (d, m) in enumerate(zip([*depth.tolist(), -1], [*least.tolist(), 0])):
        first = i
        while open_depth and open_depth[-1] > d:
            first = open_first.pop()
            out.append((first, i, open_depth.pop()))
        if d >= m and (not open_depth or open_depth[-1] < d):
            open_first.append(first)
            open_depth.append(d)
    return np.array(out, np.int64).reshape(-1, 3)


def maximal_repeats(segments: S.Segments, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of all maximal repeats in a bucket: group number, segment, bytes left of the anchor, bytes from it on."""
    nothing = (np.zeros(0, np.int64),) * 4
    _, group, count = np.unique(segments.minimiser, return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[group] > 1)
    if not len(some):
        return nothing
    segments, group = segments.take(some), group[some]
    right = contexts(segments, group, False, length)
    order = sort_rows(right)
    depth = shared(right, order[:-1], order[1:])
    del right
    left = contexts(segments, group, True, length)
    left_order = sort_rows(left)
    left_rank = np.empty(len(left_order), np.int64)
    left_rank[left_order] = np.arange(len(left_order))
    reach = left.shape[1] - 2
    nodes = intervals(depth, np.full(len(depth), max(1, length - reach)))
    found, number = [], 0
    sizes = nodes[:, 1] - nodes[:, 0] + 1
    for block in np.array_split(np.arange(len(nodes)), max(1, math.ceil(sizes.sum() / 200_000))):
        if not len(block):
            continue
        a, size = nodes[block, 0], sizes[block]
        node = np.repeat(np.arange(len(block)), size)
        place = S.expand(a, size)
        along = np.lexsort((left_rank[order[place]], node))
        place, member = place[along], order[place][along]
        need = np.maximum(0, length - nodes[block, 2])[node]
        common = np.where(node[:-1] == node[1:], shared(left, member[:-1], member[1:]), -1)
        for lo, hi, width in intervals(common, np.maximum(need[:-1], 0)).tolist():
            r = int(nodes[block[node[lo]], 2])
            inside = place[lo:hi + 1]
            if width + r >= length and depth[inside.min():inside.max()].min() == r:  # diverse to the right as well
                found.append((np.full(hi - lo + 1, number), some[member[lo:hi + 1]], np.full(hi - lo + 1, width), np.full(hi - lo + 1, r)))
                number += 1
    return tuple(np.concatenate(c) for c in zip(*found)) if found else nothing


def segments_by_bucket(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for held in S.chunks(pieces(batches, length)):
            yield grams_of(held, gram)[1]

    rows = rows.select("row_id", "mark", "text")
    hot, size = S.hot_slots(rows, grams)
    too_large, added = large_keys(rows, length, gram, hot)
    buckets = min(MAX_BUCKETS, max(1, math.ceil((3.2 * size + added) / S.BUCKET_BYTES)))
    return rows.mapInArrow(segment_task(length, gram, hot, buckets, too_large), S.SENT_DDL).groupBy("bucket")


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Packed spans of bytes to remove, several rows per document row; ``rows`` as ``superkmers.row_keys`` gives them."""
    def judge(table: pa.Table) -> pa.Table:
        segments, spans = received(table)
        _, member, left, right = maximal_repeats(segments, length)
        anchor = segments.start[member] + segments.anchor[member]
        return answer([*spans, *S.merged(segments.row[member], segments.mark[member], anchor - left, anchor + right)])

    return segments_by_bucket(rows, length, gram).applyInArrow(judge, S.FOUND_DDL)


def repeat_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Maximal repeat groups of the windows around each anchor: one row per occurrence with ``repeat`` (a number of the repeated bytes), ``n_bytes``,
    ``row_id``, ``mark``, ``start``.  A repeat that spans several anchors comes in pieces that overlap, each with all its
    occurrences.  Equal segments that one chunk holds twice are reported once; their copies are in the spans.
    """
    schema = pa.schema([("repeat", pa.int64()), ("n_bytes", pa.int64()), ("row_id", pa.int64()), ("mark", pa.int32()), ("start", pa.int64())])

    def judge(table: pa.Table) -> pa.Table:
        segments, _ = received(table)
        _, member, left, right = maximal_repeats(segments, length)
        at = segments.at[member] + segments.anchor[member]
        name = S.RangeHash(segments.data)(at - left, at + right).view(np.int64)
        start = segments.start[member] + segments.anchor[member] - left
        return pa.Table.from_arrays([pa.array(c) for c in (name, left + right, segments.row[member], segments.mark[member], start)], schema=schema)

    rows = S.row_keys(df, doc_id, text)
    return segments_by_bucket(rows, length, gram).applyInArrow(judge, "repeat long, n_bytes long, row_id long, mark int, start long").distinct()


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary: the bytes left)."""
    rows = S.row_keys(df, doc_id, text)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, content, packed in zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), b["spans"].to_pylist()):
                kept, behind, n = [], 0, 0
                for s, e in zip(*(x.tolist() for x in S.unpack_spans(packed))):
                    kept.append(content[behind:s])
                    behind, n = e, n + 1
                whole = b"".join([*kept, content[behind:]])
                out.append((doc, len(content), len(content) - len(whole), n, whole))
            columns = [list(c) for c in zip(*out)] if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    joined = with_spans(rows, repeated_spans(rows, length))
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
