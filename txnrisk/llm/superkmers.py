"""Super-k-mer partitioning: windows travel to buckets in packed runs that share a minimiser.

Units are words or bytes.  A *gram* is a short run of units, a *window* a long one.  The minimiser of a window is its gram with the smallest
order, leftmost on ties: a function of the window's content alone, so equal windows always meet in the bucket that the
minimiser's hash names.  Consecutive windows with the same minimiser form a *segment*, whose text is sent once.

Skew.  Grams that hold more than ``HOT_SHARE`` of all grams are ordered last, so a window uses one only if all its
grams are hot.  Equal segments are sent once per chunk (``local_groups``), so a bucket gets at most one row per chunk for a
text.  Grams below that share may still be the minimiser of many different segments; ``suffix`` divides those groups.

Nothing here touches Spark but ``hot_slots`` and ``row_keys``.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20      # text worked on at a time in a task
BUCKET_BYTES = 24 << 20    # text a bucket should hold, uncompressed
SLOT_BITS = 20             # slots in which grams are counted, per task
HOT_SHARE = 2.0**-14       # share of all grams from which a slot is hot: at most 2**14 hot slots
POSITION_BITS = 28         # position part of an ordering key; a chunk is far below 2**28 units
MIN_BLOCK = 1 << 15        # windows whose minimisers are sought at a time, so that a core's cache holds the steps between
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LAST = np.int64(2**63 - 1)

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring things from their hashes, order kept."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F))


class RangeHash:
    """Hash of any byte range of a buffer by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_powers.get("up", ())) < n:
            up = np.full(max(n, CHUNK_BYTES + 1), BASE)
            down = np.full(len(up), np.uint64(pow(int(BASE), -1, 2**64)))
            up[0] = down[0] = 1
            _powers["up"], _powers["down"] = np.cumprod(up), np.cumprod(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers["up"][:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _powers["down"][np.minimum(start, len(_powers["down"]) - 1)] + (end - start).astype(np.uint64))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    span = 1
    while 2 * span <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return a if span == width else np.minimum(a[: len(a) - (width - span)], a[width - span:])


def expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, one range after the other."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - first, length)


@dataclass
class Piece:
    """A document or a part of a long one.  ``base``: index of its first unit in the document."""

    row: int
    mark: int
    base: int
    units: int
    data: bytes


@dataclass
class Segments:
    """Segments of one chunk or bucket; ``row`` and ``mark`` name the document's row, ``start`` its first unit there."""

    row: np.ndarray
    mark: np.ndarray
    start: np.ndarray
    units: np.ndarray
    anchor: np.ndarray      # units from the segment's start to the minimiser
    minimiser: np.ndarray
    at: np.ndarray          # byte range in ``data``
    size: np.ndarray
    data: np.ndarray

    FIELDS = ("row", "mark", "start", "units", "anchor", "minimiser", "size")
    TYPES = ("<i8", "<i4", "<i8", "<i4", "<i4", "<u8", "<i4")

    def take(self, which: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f)[which] for f in self.FIELDS[:-1]), self.at[which], self.size[which], self.data)

    def joined(self, other: Segments) -> Segments:
        """These segments and ``other`` ones of the same chunk."""
        return Segments(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in self.FIELDS[:-1]), np.concatenate([self.at, other.at]), np.concatenate([self.size, other.size]), self.data)

    def compact(self, which: np.ndarray) -> Segments:
        """Some segments with a copy of just their texts, back to back."""
        size = self.size[which]
        fields = (getattr(self, f)[which] for f in self.FIELDS[:-1])
        return Segments(*fields, np.cumsum(size) - size, size, self.data[expand(self.at[which], size)])

    def text(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i] + self.size[i]].tobytes()

    def pack(self) -> bytes:
        """Compressed bytes of all fields and the texts, one after the other."""
        columns = []
        for name, kind in zip(self.FIELDS, self.TYPES):
            values = getattr(self, name).astype(kind)
            if name in ("row", "start"):  # neighbours are close
                values = np.diff(values, prepend=values.dtype.type(0))
            columns.append(values.view(np.uint8).reshape(len(values), -1).T.tobytes())
        texts = self.data[expand(self.at, self.size)].tobytes()
        return zstandard.ZstdCompressor(level=7).compress(b"".join([struct.pack("<q", len(self.row)), *columns, texts]))

    @classmethod
    def unpack(cls, blobs: list[bytes]) -> Segments:
        parts: dict[str, list[np.ndarray]] = {f: [] for f in cls.FIELDS}
        texts = []
        for blob in blobs:
            raw = zstandard.ZstdDecompressor().decompress(blob)
            (n,), at = struct.unpack_from("<q", raw), 8
            for name, kind in zip(cls.FIELDS, cls.TYPES):
                width = np.dtype(kind).itemsize
                values = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()
                parts[name].append(np.cumsum(values) if name in ("row", "start") else values)
                at += n * width
            texts.append(np.frombuffer(raw, np.uint8, offset=at))
        fields = {f: np.concatenate(v) if v else np.zeros(0, t) for (f, v), t in zip(parts.items(), cls.TYPES)}
        size = fields.pop("size").astype(np.int64)
        return cls(**fields, at=np.cumsum(size) - size, size=size, data=np.concatenate(texts) if texts else np.zeros(0, np.uint8))


def order_keys(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Ordering key of every gram: hot ones last, then by hash, then by position."""
    rank = (grams & np.uint64(2 ** (63 - POSITION_BITS) - 1)) | (hot[grams >> np.uint64(64 - SLOT_BITS)].astype(np.uint64) << np.uint64(63 - POSITION_BITS))
    return (rank << np.uint64(POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)


def anchors(grams: np.ndarray, hot: np.ndarray, per_window: int) -> np.ndarray:
    """Position of every window's minimiser among ``per_window`` grams, block by block."""
    n = max(0, len(grams) - per_window + 1)
    where = np.empty(n, np.int64)
    for at in range(0, n, MIN_BLOCK):
        size = min(MIN_BLOCK, n - at)
        least = sliding_min(order_keys(grams[at:at + size + per_window - 1], hot), per_window)
        where[at:at + size] = (least & np.uint64(2**POSITION_BITS - 1)).astype(np.int64) + at
    return where


def runs(grams: np.ndarray, hot: np.ndarray, per_window: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and minimiser position of every segment.  ``valid`` marks windows inside one document."""
    places = anchors(grams, hot, per_window)
    valid = valid[: len(places)]
    parts = (places[1:] != places[:-1]) | ~(valid[1:] & valid[:-1])  # between a window and the next one
    edge = np.ones(min(1, len(places)), bool)
    first = np.flatnonzero(valid & np.concatenate([edge, parts]))
    last = np.flatnonzero(valid & np.concatenate([parts, edge]))
    return first, last, places[first]


def local_groups(segments: Segments, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the segments and, along it, the number of the group of equal texts (equal hash, then equal bytes)."""
    order = np.lexsort((hashes, segments.size))
    new = np.ones(len(order), bool)
    same = (np.diff(hashes[order]) == 0) & (np.diff(segments.size[order]) == 0)
    for i in np.flatnonzero(same).tolist():
        a, b = int(order[i]), int(order[i + 1])
        same[i] = segments.anchor[a] == segments.anchor[b] and segments.text(a) == segments.text(b)
    new[1:] = ~same
    return order, np.cumsum(new) - 1


def chunks(rows: Iterator[Piece]) -> Iterator[list[Piece]]:
    """Pieces gathered up to ``CHUNK_BYTES``."""
    held, size = [], 0
    for piece in rows:
        held.append(piece)
        size += len(piece.data)
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


# --------------------------------------------------------------------------- spans

SENT = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("row_id", pa.int64()), ("mark", pa.int32()), ("spans", pa.binary())])
SENT_DDL = "bucket int, blob binary, row_id long, mark int, spans binary"
FOUND = pa.schema([("row_id", pa.int64()), ("mark", pa.int32()), ("spans", pa.binary())])
FOUND_DDL = "row_id long, mark int, spans binary"


def merged(row: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """For each document row, its spans packed as pairs of 64-bit numbers, touching ones united."""
    if not len(row):
        return
    order = np.lexsort((end, start, mark, row))
    row, mark, start, end = row[order], mark[order], start[order], end[order]
    edges = np.flatnonzero((np.diff(row) != 0) | (np.diff(mark) != 0)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(row)]):
        s, e = union(start[a:b], end[a:b])
        yield int(row[a]), int(mark[a]), np.stack([s, e], axis=1).astype("<i8").tobytes()


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges; ``start`` ascends."""
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


def unpack_spans(packed: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """United spans of several packed lists."""
    both = np.frombuffer(b"".join(packed or []), "<i8").reshape(-1, 2)
    both = both[np.argsort(both[:, 0], kind="stable")]
    return union(both[:, 0], both[:, 1]) if len(both) else (both[:, 0], both[:, 1])


# --------------------------------------------------------------------------- Spark

def row_keys(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``text`` and the two numbers that name a row.

    ``row_id`` is the ID; rows without one take a hash of their text.  ``mark`` hashes the text, so that rows repeating an
    ID stay apart; its lowest bit says that the ID is missing.  Equal rows share both numbers, and also their results.
    """
    ids, content = F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    missing = ids.isNull().cast("int")
    return df.select(
        ids.alias("doc_id"), content.alias("text"), F.coalesce(ids, F.xxhash64(content)).alias("row_id"),
        F.hash(content).bitwiseAND(-2).bitwiseOR(missing).alias("mark"),
    )


def hot_slots(rows: DataFrame, grams: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> tuple[np.ndarray, int]:
    """Which slots of gram hashes are hot, over all documents, and the bytes of all texts.

    A task counts all its grams but reports only slots above half of ``HOT_SHARE`` of its own grams: a slot above that share of
    all grams must be above half of it in the tasks that hold at least half of its grams.  At most 2**SLOT_BITS numbers reach
    the driver, whatever the data, and normally a few.  Slots -1 and -2 carry the numbers of grams and bytes.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = np.zeros(2**SLOT_BITS, np.int64), [0]

        def measured() -> Iterator[pa.RecordBatch]:
            for b in batches:
                size[0] += sum(len(x) for x in b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist())
                yield b

        for hashes in grams(measured()):
            total += np.bincount((hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=2**SLOT_BITS)
        slots = np.flatnonzero(total > HOT_SHARE / 2 * max(1, total.sum()))
        yield pa.RecordBatch.from_pydict({"slot": [-1, -2, *slots.tolist()], "n": [int(total.sum()), size[0], *total[slots].tolist()]})

    counted = rows.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.collect()
    totals = {r["slot"]: r["n"] for r in found if r["slot"] < 0}
    hot = np.zeros(2**SLOT_BITS, bool)
    for r in found:
        if r["slot"] >= 0 and r["n"] > HOT_SHARE / 2 * totals[-1]:
            hot[r["slot"]] = True
    return hot, totals.get(-2, 0)
