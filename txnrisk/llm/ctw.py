"""Context-tree weighting over binary-decomposed bytes: the probability of a text, and so its code length per byte.

Symbols.  A text is taken as its words (runs of anything but ASCII white space, A-Z lower-cased) joined by one blank, in UTF-8, and one end
byte 0xFF, which no UTF-8 text holds.  So the model is a distribution over texts.  Before its first byte a text has ends as its context.

Model.  A byte is eight binary decisions; the bits decided so far name one of 255 places.  Every place has a context tree over the
``DEPTH`` bytes before, the latest first.  A node holds how often either bit followed; its Krichevsky-Trofimov estimate depends on these two
numbers alone.  A node's weighted probability is half its own estimate and half the product of its children's, from the deepest contexts up; this
fixes how much every depth counts in a prediction.  Counts come from the training rows and are frozen: scoring never changes them.

Work.  Nothing holds the whole model.
1. Texts are stored in pieces (cut at blanks) and dealt to chunks of ``CHUNK_BYTES``.
2. A chunk reports each distinct gram (context and byte) and word once, with its number in training rows, packed by hash buckets: none is reported more often
   than there are chunks.  A bucket's sums are the counts.
3. Trees are weighted bottom-up, two bytes of context at a time: contexts that agree in their latest three bytes meet in a bucket, then those
   that agree in the latest one, and the last step is at most 256 x 255 nodes.  So no node gathers more than 65,536 contexts, however large the corpus is.
4. The mixture comes down the same steps as three numbers per node, until every gram has its logarithm (kept to 32 bits).
5. Logarithms return to the chunks that reported their grams, counts of words only where they differ from the chunk's own, and chunks score their pieces.

Null and empty texts are one end.  Rows may lack or repeat an ID: each is scored by itself.  An empty table gives an empty result; without training
rows every bit has probability 1/2 and the base counts no tokens.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import discard, encoded, small_batches
from txnrisk.llm.superkmers import mix
from txnrisk.session import working_path

DEPTH = 5                   # bytes of context, 6 at most; grams are these and the byte that follows
TIERS = (DEPTH, 3, 1)       # context lengths at which nodes meet; the last tier is folded by the driver
CHUNK_BYTES = 32 << 20      # text whose grams are reported and scored together
PIECE_BYTES = 1 << 20
BLOCK = 1 << 20             # positions worked on at a time
BUCKET_BYTES = 8 << 20      # text whose grams, if all differ, fill a bucket
BUCKET_ROWS = 200_000       # nodes in a bucket
END = b"\xff"
END_WORD = b" "             # the end as a token: no word holds white space
TABLE = 1 << 16             # counts whose log factorials are tabled

_tables: dict[float, np.ndarray] = {}


# --------------------------------------------------------------------------- the tree

def log_rise(n: np.ndarray, start: float) -> np.ndarray:
    """Logarithm of start * (start + 1) * ... * (start + n - 1)."""
    if start not in _tables:
        _tables[start] = np.concatenate([[0.0], np.cumsum(np.log(np.arange(TABLE) + start))])
    out = _tables[start][np.minimum(n, TABLE)]
    large = n > TABLE
    if large.any():  # Stirling's series, exact to double precision here
        x = n[large] + start
        out[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) - math.lgamma(start)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of any sequence with these numbers of zeros and ones."""
    return log_rise(n0, 0.5) + log_rise(n1, 0.5) - log_rise(n0 + n1, 1.0)


class Level:
    """Nodes of one depth in key order.  A key is the place, then the context, latest byte first: dropping its last byte gives the parent's.

    ``below``: log of the product of the children's weighted probabilities; None at the deepest contexts, which have no children.
    """

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.key, self.n0, self.n1, self.below = key, n0, n1, below
        own = log_kt(n0, n1)
        self.weighted = own if below is None else np.logaddexp(own, below) - math.log(2)
        self.share = np.ones(len(key)) if below is None else 1 / (1 + np.exp(np.minimum(below - own, 700.0)))
        self.one = (n1 + 0.5) / (n0 + n1 + 1.0)

    def parents(self) -> tuple[Level, np.ndarray]:
        """The level above and, for every node here, its parent's place there."""
        up = self.key >> np.uint64(8)
        new = np.concatenate([[True], up[1:] != up[:-1]])
        first = np.flatnonzero(new)
        return Level(up[first], *(np.add.reduceat(x, first) for x in (self.n0, self.n1, self.weighted))), np.cumsum(new) - 1


class Mixture:
    """What all contexts shorter than a level's give to its nodes: P(bit) = given[bit] + rest * P(bit | this context and longer ones)."""

    def __init__(self, zero: np.ndarray, one: np.ndarray, rest: np.ndarray):
        self.zero, self.one, self.rest = zero, one, rest

    def past(self, level: Level) -> Mixture:
        """The same, with the level's own estimates added."""
        own = self.rest * level.share
        return Mixture(self.zero + own * (1 - level.one), self.one + own * level.one, self.rest * (1 - level.share))

    def at(self, which: np.ndarray) -> Mixture:
        return Mixture(self.zero[which], self.one[which], self.rest[which])


def climb(level: Level, steps: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels from ``level`` up, and the links from each to the next."""
    levels, links = [level], []
    for _ in range(steps):
        above, link = levels[-1].parents()
        levels.append(above)
        links.append(link)
    return levels, links


def descend(levels: list[Level], links: list[np.ndarray], given: Mixture) -> Mixture:
    """The mixture at the deepest of the levels from that at the topmost."""
    for level, link in zip(levels[:0:-1], links[::-1]):
        given = given.past(level).at(link)
    return given


def places(symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of a byte's eight decisions, its place and its bit."""
    for j in range(8):
        yield np.uint64(1 << j) | (symbol >> np.uint64(8 - j)), (symbol >> np.uint64(7 - j)) & np.uint64(1)


def deepest(context: np.ndarray, place: np.ndarray, bit: np.ndarray, n: np.ndarray, depth: int) -> tuple[Level, np.ndarray]:
    """Nodes of the full context from counted grams, and every gram's node."""
    key = (place << np.uint64(8 * depth)) | context
    order = np.argsort(key, kind="stable")
    key, ones, total = key[order], (n * bit.astype(np.int64))[order], n[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)
    n1, both = np.add.reduceat(ones, first), np.add.reduceat(total, first)
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    return Level(key[first], both - n1, n1, None), where


# --------------------------------------------------------------------------- pieces and chunks

def canonical(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def cut(text: bytes, depth: int) -> Iterator[bytes]:
    """Pieces of a canonical text, each after its ``depth`` bytes of context; whole words, blanks before them."""
    whole, at = END * depth + text + END, depth
    while len(whole) - at > 2 * PIECE_BYTES:
        to = whole.find(b" ", at + PIECE_BYTES)
        if to < 0:
            break
        yield whole[at - depth:to]
        at = to
    yield whole[at - depth:]


PIECES = pa.schema([("chunk", pa.int64()), ("row_id", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("size", pa.int64()), ("data", pa.binary())])
PIECES_DDL = "chunk long, row_id long, doc_id long, train boolean, size long, data binary"


def piece_task(depth: int, chunk_bytes: int):
    """Task that turns rows into compressed pieces, numbered by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=3).compress
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            out = []
            for row, doc, train, text in zip(b["row_id"].to_pylist(), b["doc_id"].to_pylist(), b["train"].to_pylist(), encoded(b["text"])):
                for piece in cut(canonical(text), depth):
                    if held >= chunk_bytes:
                        chunk, held = chunk + 1, 0
                    held += len(piece)
                    out.append((chunk, row, doc, train, len(piece), deflate(piece)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)], schema=PIECES)
    return run


def words_of(piece: bytes, depth: int) -> list[bytes]:
    """A piece's tokens, a text's end included."""
    body = piece[depth:]
    return [*body[:-1].split(), END_WORD] if body.endswith(END) else body.split()


def codes(pieces: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of the pieces' symbols in blocks of about ``BLOCK``, with the number of the piece of each.

    A block has so few pieces that their numbers, from its first one on, fit into the bits that a gram leaves free.
    """
    at, most = 0, 1 << (64 - 8 * (depth + 1))
    while at < len(pieces):
        to, size = at, 0
        while to < len(pieces) and size < BLOCK and to - at < most:
            size += len(pieces[to])
            to += 1
        data = np.frombuffer(b"\0" * 8 + b"".join(pieces[at:to]), np.uint8)
        eight = np.ndarray(len(data) - 8, "<u8", data, strides=(1,))  # the eight bytes before every symbol, the latest one highest
        lengths = np.array([len(p) for p in pieces[at:to]])
        owner = np.repeat(np.arange(at, to), lengths)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) >= depth
        for a in range(0, len(owner), 2 * BLOCK):  # one long piece is several blocks
            use = inside[a:a + 2 * BLOCK]
            context = eight[a:a + 2 * BLOCK][use] >> np.uint64(8 * (8 - depth))
            yield (context << np.uint64(8)) | data[8 + a:8 + a + 2 * BLOCK][use], owner[a:a + 2 * BLOCK][use]
        at = to


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their numbers."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    if not len(key):
        return key, n
    return key[first], np.add.reduceat(n[order], first)


COUNTS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("grams", pa.binary()), ("words", pa.binary())])
COUNTS_DDL = "chunk long, bucket int, grams binary, words binary"
COUNTED, VALUED = ("<u8", "<i8"), ("<u8", "<f4")  # arrays of packed counts, and of packed logarithms


def pack(arrays: list[np.ndarray], words: list[bytes] = []) -> bytes:  # noqa: B006 (never changed)
    """Compressed bytes of arrays and of words in order.  The first array ascends and is stored by differences."""
    parts = [np.diff(arrays[0], prepend=arrays[0].dtype.type(0)), *arrays[1:]]
    heads = [struct.pack("<q", len(words)), b"\n".join(words), b"\n" if words else b""]
    body = [x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in parts]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([struct.pack("<q", len(arrays[0])), *body, *heads]))


def unpack(blob: bytes, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,), at, arrays = struct.unpack_from("<q", raw), 8, []
    for k in kinds:
        width = np.dtype(k).itemsize
        arrays.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(k).ravel())
        at += n * width
    arrays[0] = np.cumsum(arrays[0], dtype=arrays[0].dtype)
    (n,) = struct.unpack_from("<q", raw, at)
    return arrays, raw[at + 8:].split(b"\n")[:n]


def parts_of(key: np.ndarray, count: int) -> list[np.ndarray]:
    """Places of ascending keys, dealt to ``count`` parts by hash, in order within each."""
    part = (mix(key) % np.uint64(count)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, count)))


class ChunkCounts:
    """Distinct grams and words of one chunk with their numbers in training rows."""

    def __init__(self, depth: int):
        self.depth, self.words, self.parts, self.rows = depth, Counter(), [], 0
        self.held: dict[bool, list[bytes]] = {True: [], False: []}
        self.size = 0

    def add(self, piece: bytes, train: bool) -> None:
        self.held[train].append(piece)
        self.size += len(piece)
        words = words_of(piece, self.depth)
        self.words.update(words) if train else self.words.update(dict.fromkeys(words, 0))
        if self.size >= BLOCK:
            self.settle()

    def settle(self) -> None:
        for train, pieces in self.held.items():
            for block, _ in codes(pieces, self.depth):
                gram, n = np.unique(block, return_counts=True)
                self.parts.append((gram, n.astype(np.int64) * train))
                self.rows += len(gram)
            pieces.clear()
        self.size = 0
        if self.rows > 4 * BLOCK:
            self.parts = [summed(self.parts)]
            self.rows = 0  # what is held anew since

    def blobs(self, chunk: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """One row per bucket: grams and words dealt by their hashes."""
        self.settle()
        if not self.words:
            return
        gram, n = summed(self.parts)
        words: list[list[bytes]] = [[] for _ in range(buckets)]
        for w in self.words:
            words[zlib.crc32(w) % buckets].append(w)
        out = []
        for bucket, (which, mine) in enumerate(zip(parts_of(gram, buckets), words)):
            if len(which) or mine:
                mine.sort()
                counts = np.array([self.words[w] for w in mine], "<i8")
                out.append((chunk, bucket, pack([gram[which], n[which]]), pack([np.arange(len(mine)), counts], mine)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), COUNTS)], schema=COUNTS)


def count_task(depth: int, buckets: int):
    """Task over stored pieces: each chunk's distinct grams and words.  A chunk read by two tasks is reported by both, which changes no sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        chunk, counts = None, ChunkCounts(depth)
        for b in batches:
            for c, train, data in zip(b["chunk"].to_pylist(), b["train"].to_pylist(), b["data"].to_pylist()):
                if c != chunk:
                    yield from counts.blobs(chunk, buckets)
                    chunk, counts = c, ChunkCounts(depth)
                counts.add(inflate(data), train)
        yield from counts.blobs(chunk, buckets)
    return run


def word_totals(packed: list[bytes]) -> tuple[Counter, list[tuple[list[bytes], np.ndarray]]]:
    """Sums of packed word counts, and the counts by themselves."""
    total, own = Counter(), []
    for blob in packed:
        (_, n), words = unpack(blob, ("<i8", "<i8"))
        own.append((words, n))
        total.update(dict(zip(words, n.tolist())))
    return total, own


TOTALS_DDL = "bucket int, grams binary, total long, distinct long"
TOTALS = pa.schema([("bucket", pa.int32()), ("grams", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64())])


def total_task(buckets: int, shift: int):
    """Task over one bucket of counts: its distinct grams with their sums, dealt by the context's latest bytes, and the numbers of its words."""
    def run(t: pa.Table) -> pa.Table:
        key, n = summed([tuple(unpack(x, COUNTED)[0]) for x in t["grams"].to_pylist()])
        words, _ = word_totals(t["words"].to_pylist())
        out = [(None, None, sum(words.values()), sum(c > 0 for c in words.values()))]
        part = (mix(key >> np.uint64(shift)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        for bucket, which in enumerate(np.split(order, np.searchsorted(part[order], np.arange(1, buckets)))):
            if len(which):
                out.append((bucket, pack([key[which], n[which]]), 0, 0))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TOTALS)], schema=TOTALS)
    return run


RETURN = pa.schema([("chunk", pa.int64()), ("grams", pa.binary()), ("words", pa.binary())])


def return_task(counts: pa.Table, logs: pa.Table) -> pa.Table:
    """One bucket's values for the chunks that reported its grams and words: every gram's logarithm, and counts that differ from the chunk's own."""
    out = []
    if counts.num_rows:
        nothing = [np.zeros(0, k) for k in VALUED]  # a bucket may hold words only
        key, value = (np.concatenate(x) for x in zip(nothing, *(unpack(x, VALUED)[0] for x in logs["grams"].to_pylist())))
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        total, own = word_totals(counts["words"].to_pylist())
        for chunk, packed, (words, n) in zip(counts["chunk"].to_pylist(), counts["grams"].to_pylist(), own):
            mine = unpack(packed, COUNTED)[0][0]
            differs = [(w, total[w]) for w, c in zip(words, n.tolist()) if total[w] != c]
            sums = np.array([c for _, c in differs], "<i8")
            out.append((chunk, pack([mine, value[np.searchsorted(key, mine)]]), pack([np.arange(len(sums)), sums], [w for w, _ in differs])))
    return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(RETURN)], schema=RETURN)


SCORES_DDL = "row_id long, doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"
SCORES = pa.schema([
    ("row_id", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])


def score_chunk(pieces: pa.Table, returned: pa.Table, depth: int, total: int, distinct: int) -> pa.Table:
    """Scores of one chunk's pieces from the logarithms of its grams and the counts of its words."""
    key, value = (np.concatenate(x) for x in zip(*(unpack(x, VALUED)[0] for x in returned["grams"].to_pylist())))
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order].astype(np.float64)
    inflate = zstandard.ZstdDecompressor().decompress
    data = [inflate(x) for x in pieces["data"].to_pylist()]
    known: dict[bytes, int] = Counter()  # the chunk's own training counts stand where no other chunk adds to them
    for train, piece in zip(pieces["train"].to_pylist(), data):
        if train:
            known.update(words_of(piece, depth))
    for blob in returned["words"].to_pylist():
        (_, n), words = unpack(blob, ("<i8", "<i8"))
        dict.update(known, zip(words, n.tolist()))
    out = np.zeros(len(data))
    for block, owner in codes(data, depth):
        # Gram and piece in one number: sorting these and looking up each distinct gram once is far faster than a search per position.
        low = np.uint64(64 - 8 * (depth + 1))
        base = owner[0] if len(owner) else 0
        both = np.sort((block << low) | (owner - base).astype(np.uint64))
        gram = both >> low
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[:len(gram)])
        logs = np.repeat(value[np.searchsorted(key, gram[first])], np.diff(np.append(first, len(gram))))
        sums = np.bincount((both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64), logs)
        out[base:base + len(sums)] += sums
    n_tokens, n_known, base = [], [], []
    for piece in data:
        words = words_of(piece, depth)
        c = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))
        n_tokens.append(len(words))
        n_known.append(int((c > 0).sum()))
        base.append(float(np.log10((c + 1) / (total + distinct + 1)).sum()))
    columns = [
        pieces["row_id"], pieces["doc_id"], pieces["train"], pa.array([len(x) - depth for x in data], pa.int64()), pa.array(n_tokens, pa.int64()),
        pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(out, pa.float64()),
    ]
    return pa.Table.from_arrays(columns, schema=SCORES)


# --------------------------------------------------------------------------- Spark

NODES_DDL = "home int, key long, n0 long, n1 long, below double"
MIX_DDL = "home int, key long, zero double, one double, rest double"
LOGS_DDL = "bucket int, grams binary"


def nodes_table(levels: list[Level], home: int = 0) -> pa.Table:
    """Rows of levels' nodes; ``home``: the bucket of grams they come from."""
    columns = [np.concatenate(c) for c in zip(*((x.key.view(np.int64), x.n0, x.n1, x.below) for x in levels))]
    return pa.Table.from_arrays([np.full(len(columns[0]), home, np.int32), *columns], names=["home", "key", "n0", "n1", "below"])


def mixture_table(home: np.ndarray, key: np.ndarray, given: Mixture) -> pa.Table:
    return pa.Table.from_arrays([home, key.view(np.int64), given.zero, given.one, given.rest], names=["home", "key", "zero", "one", "rest"])


def level_of(nodes: pa.Table) -> tuple[Level, np.ndarray]:
    """Nodes in key order, and their homes."""
    key = nodes["key"].to_numpy().view(np.uint64)
    order = np.argsort(key, kind="stable")
    return Level(key[order], *(nodes[c].to_numpy()[order] for c in ("n0", "n1", "below"))), nodes["home"].to_numpy()[order]


def given_at(level: Level, mixture: pa.Table) -> Mixture:
    """The mixture rows of a level's nodes, in its order."""
    key = mixture["key"].to_numpy().view(np.uint64)
    order = np.argsort(key, kind="stable")
    which = order[np.searchsorted(key[order], level.key)]
    return Mixture(*(mixture[c].to_numpy()[which] for c in ("zero", "one", "rest")))


def gram_arrays(grams: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, byte and count of a bucket's grams."""
    gram, n = (np.concatenate(x) for x in zip(*(unpack(x, COUNTED)[0] for x in grams["grams"].to_pylist())))
    return gram >> np.uint64(8), gram & np.uint64(255), n


def climb_grams_task(depth: int, top: int):
    def run(key: tuple[pa.Scalar], grams: pa.Table) -> pa.Table:
        context, symbol, n = gram_arrays(grams)
        levels = [climb(deepest(context, place, bit, n, depth)[0], depth - top)[0][-1] for place, bit in places(symbol)]
        return nodes_table(levels, key[0].as_py())
    return run


def climb_task(steps: int):
    def run(nodes: pa.Table) -> pa.Table:
        return nodes_table([climb(level_of(nodes)[0], steps)[0][-1]])
    return run


def descend_task(steps: int):
    def run(nodes: pa.Table, mixture: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return mixture_table(np.zeros(0, np.int32), np.zeros(0, np.uint64), Mixture(*(np.zeros(0),) * 3))
        level, home = level_of(nodes)
        levels, links = climb(level, steps)
        return mixture_table(home, level.key, descend(levels, links, given_at(levels[-1], mixture)))
    return run


def log_task(depth: int, top: int, buckets: int):
    """Task over one bucket of grams: log10 of every gram's byte after its context, dealt as the chunks dealt their grams."""
    def run(grams: pa.Table, mixture: pa.Table) -> pa.Table:
        out = []
        if grams.num_rows:
            context, symbol, n = gram_arrays(grams)
            logs = np.zeros(len(n))
            for place, bit in places(symbol):
                level, where = deepest(context, place, bit, n, depth)
                levels, links = climb(level, depth - top)
                final = descend(levels, links, given_at(levels[-1], mixture)).past(level)
                logs += np.log10(np.where(bit == 1, final.one[where], final.zero[where]))
            gram = (context << np.uint64(8)) | symbol
            order = np.argsort(gram, kind="stable")
            gram, logs = gram[order], logs[order].astype("<f4")
            out = [(bucket, pack([gram[w], logs[w]])) for bucket, w in enumerate(parts_of(gram, buckets)) if len(w)]
        return pa.Table.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["bucket", "grams"])
    return run


def dealt(nodes: DataFrame, key: Column, rows: int) -> DataFrame:
    return nodes.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows // BUCKET_ROWS)))))


def gram_logs(grams: DataFrame, buckets: int, keep, tiers: tuple[int, ...]) -> DataFrame:
    """(bucket, grams): packed grams with the log10 probability of their last byte, from packed grams with their counts.  ``keep(df, name)`` stores a table."""
    depth, first, last = tiers[0], tiers[1], tiers[-1]
    nodes = {first: keep(grams.groupBy("bucket").applyInArrow(climb_grams_task(depth, first), NODES_DDL), "nodes")}
    sizes = {first: nodes[first].count()}

    def meeting(a: int, b: int) -> DataFrame:
        return dealt(nodes[a], F.shiftrightunsigned(F.col("key"), 8 * (a - b)), sizes[a])

    steps = list(zip(tiers[1:], tiers[2:]))
    for a, b in steps:
        nodes[b] = keep(meeting(a, b).groupBy("bucket").applyInArrow(climb_task(a - b), NODES_DDL), "nodes")
        sizes[b] = nodes[b].count()

    top = nodes[last].toArrow()  # one byte of context: at most 256 x 255 nodes
    mixture = grams.sparkSession.createDataFrame([], MIX_DDL)
    if top.num_rows:
        level, home = level_of(top)
        levels, links = climb(level, last)
        roots = len(levels[-1].key)
        given = descend(levels, links, Mixture(np.zeros(roots), np.zeros(roots), np.ones(roots)))
        mixture = grams.sparkSession.createDataFrame(mixture_table(home, level.key, given))
    for a, b in steps[::-1]:
        down = meeting(a, b).groupBy("bucket").cogroup(dealt(mixture, F.col("key"), sizes[a]).groupBy("bucket"))
        mixture = down.applyInArrow(descend_task(a - b), MIX_DDL)
    return grams.groupBy("bucket").cogroup(mixture.groupBy("home")).applyInArrow(log_task(depth, first, buckets), LOGS_DDL)


def score(df: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per row of ``df``, learned from those where ``train`` is true.

    ``doc_id``, ``held_out``, ``n_bytes`` (symbols, the end included), ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (smoothed
    word frequencies, log10), ``score`` (log10 probability of the text) and ``bits_per_byte``.
    """
    spark, depth, written = small_batches(df.sparkSession), tiers[0], []

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = working_path(spark, f"ctw-{name}")
        table.write.parquet(path)
        written.append(path)
        return spark.read.parquet(path)

    rows = df.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("string").alias("text"))
    pieces = keep(rows.mapInArrow(piece_task(depth, chunk_bytes), PIECES_DDL), "pieces")
    size = pieces.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    counts = keep(pieces.select("chunk", "train", "data").mapInArrow(count_task(depth, buckets), COUNTS_DDL), "counts")
    totals = keep(counts.groupBy("bucket").applyInArrow(total_task(buckets, 8 * (depth - tiers[1] + 1)), TOTALS_DDL), "totals")
    total, distinct = totals.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    logs = gram_logs(totals.where("bucket is not null").select("bucket", "grams"), buckets, keep, tiers)
    returned = counts.groupBy("bucket").cogroup(logs.groupBy("bucket")).applyInArrow(return_task, "chunk long, grams binary, words binary")
    scored = pieces.drop("size").groupBy("chunk").cogroup(returned.groupBy("chunk")).applyInArrow(
        lambda p, r: score_chunk(p, r, depth, total, distinct), SCORES_DDL)
    out = keep(
        scored.groupBy("row_id").agg(
            F.first("doc_id").alias("doc_id"), F.first(~F.col("train")).alias("held_out"), *[F.sum(c).alias(c) for c in ("n_bytes", "n_tokens", "n_known", "base_score", "score")]),
        "scores")
    for path in written[:-1]:
        discard(spark, path)
    return out.select(
        "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
        (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"))
