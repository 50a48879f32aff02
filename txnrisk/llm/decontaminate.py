"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are lower-cased and read as words (ASCII punctuation parts them).  How many documents hold each n-gram of the benchmark is counted over the whole corpus;
an item's seeds are its n-grams held by at most ``RARE_SHARE`` of all documents or by at most ``TYPICAL`` times as many as its median
n-gram, and in any case its ``MIN_SEEDS`` rarest.  So an item that leaked everywhere keeps its seeds, and only phrases that are common
beyond the item are left out.  Items shorter than ``GRAM`` words are one seed as a whole.

A document that holds a seed is a candidate at the place where the item would lie.  The words there, with some room on either side,
are aligned locally with the item's (match 1, mismatch and gap ``PENALTY``), and the best alignment's score over the item's number of words
is the pair's score: 1 for an exact copy, 0.7 when every fifth word was replaced.  Pairs from ``THRESHOLD`` on with at least
``MIN_MATCHES`` points (or the whole item) are contaminated.

The benchmark is the query set: it goes to the tasks in blocks of about ``BLOCK_BYTES``, one pass over the corpus per block.

Null or empty texts and items match nothing.  Repeated documents or items each give their rows; an item without an ID
keeps its null ID.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import superkmers as S

GRAM = 3
RARE_SHARE = 1e-3
TYPICAL = 4
MIN_SEEDS = 8
THRESHOLD = 0.5
MIN_MATCHES = 5
PENALTY = 0.5
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
FILTER_BITS = 20

_BLANKS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain(text: str | None) -> bytes:
    """Lower-cased UTF-8 bytes, ASCII characters other than letters and digits as blanks, a blank at the end."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANKS) + b" "


@dataclass
class Words:
    """Word hashes of several texts and the text each word belongs to; ``first`` is each text's first word."""

    hashes: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        data = np.frombuffer(b"".join(texts), np.uint8)
        filled = data != 32
        before = np.concatenate([[False], filled[:-1]])
        start, end = np.flatnonzero(filled & ~before), np.flatnonzero(~filled & before)
        ends = np.cumsum([len(t) for t in texts])
        owner = np.searchsorted(ends, start, side="right")
        return cls(S.RangeHash(data)(start, end), owner, np.searchsorted(owner, np.arange(len(texts) + 1)))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash of every run of ``size`` words inside one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = self.hashes[:n]
        for k in range(1, size):
            out = S.join_hashes(out, self.hashes[k:n + k])
        at = np.flatnonzero(self.owner[:n] == self.owner[size - 1:])
        return at, out[at]


class Index:
    """N-grams of one block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int | None, str | None]], gram: int):
        self.ids = [i for i, _ in items]
        self.words = Words.of([plain(t) for _, t in items]) if items else Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64))
        self.length = np.diff(self.words.first)
        self.sizes = sorted({gram, *(int(n) for n in self.length if 0 < n < gram)})
        hashes, item, place, size = [], [], [], []
        for s in self.sizes:
            at, h = self.words.grams(s)
            owner = self.words.owner[at]
            use = (self.length[owner] >= gram) if s == gram else (self.length[owner] == s)
            hashes.append(h[use])
            item.append(owner[use])
            place.append(at[use] - self.words.first[owner[use]])
            size.append(np.full(use.sum(), s))
        self.hash, self.item, self.place, self.size = (np.concatenate(x) for x in (hashes, item, place, size))
        self.sort()

    def sort(self) -> None:
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.place, self.size = (x[order] for x in (self.hash, self.item, self.place, self.size))
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.hash >> np.uint64(64 - FILTER_BITS)] = True

    def keep_rare(self, held_by: np.ndarray, documents: int) -> None:
        """Only the seeds: ``held_by`` says for each distinct hash, in order, how many documents hold it."""
        spread = held_by[np.searchsorted(np.unique(self.hash), self.hash)]
        order = np.lexsort((self.place, spread, self.item))
        item, spread_there = self.item[order], spread[order]
        first, end = np.searchsorted(item, item), np.searchsorted(item, item, side="right")
        typical = spread_there[(first + end - 1) // 2]
        seed = np.zeros(len(order), bool)
        seed[order] = (np.arange(len(order)) - first < MIN_SEEDS) | (spread_there <= np.maximum(RARE_SHARE * documents, TYPICAL * typical))
        self.hash, self.item, self.place, self.size = (x[seed] for x in (self.hash, self.item, self.place, self.size))
        self.sort()

    def lookup(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places in the texts and entries of the index with equal n-grams."""
        places, entries = [], []
        for s in self.sizes:
            at, h = words.grams(s)
            some = self.maybe[h >> np.uint64(64 - FILTER_BITS)]
            at, h = at[some], h[some]
            a, b = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, side="right")
            entry, at = S.expand(a, b - a), np.repeat(at, b - a)
            use = self.size[entry] == s
            places.append(at[use])
            entries.append(entry[use])
        return np.concatenate(places), np.concatenate(entries)


def align(item: np.ndarray, passage: np.ndarray, penalty: float = PENALTY) -> tuple[float, int]:
    """Best local alignment of two word sequences: score, and where it ends in ``passage`` (exclusive)."""
    slide = penalty * np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1), 0.0, 0
    for word in item:
        step = np.zeros(len(passage) + 1)
        step[1:] = np.maximum(row[:-1] + np.where(passage == word, 1.0, -penalty), row[1:] - penalty)
        step = np.maximum(step, 0.0)
        row = np.maximum.accumulate(step + slide) - slide  # gaps along the passage
        top = int(row.argmax())
        if row[top] > best:
            best, end = float(row[top]), top
    return best, end


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """IDs and plain texts, gathered up to ``SLICE_BYTES``."""
    ids, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b["doc_id"], b["text"]):
            ids.append(doc.as_py())
            texts.append(plain(text.as_py()))
            size += len(texts[-1])
            if size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def holders(docs: DataFrame, index: Index) -> tuple[np.ndarray, int]:
    """How many documents hold each distinct n-gram of the index, and how many documents there are."""
    names = np.unique(index.hash)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(len(names), np.int64), 0
        for ids, texts in slices(batches):
            n += len(ids)
            words = Words.of(texts)
            place, entry = index.lookup(words)
            pairs = np.unique(np.stack([np.searchsorted(names, index.hash[entry]), words.owner[place]], axis=1), axis=0)
            held += np.bincount(pairs[:, 0], minlength=len(names))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"gram": [-1, *some.tolist()], "n": [n, *held[some].tolist()]})

    found = docs.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # one row per n-gram of the block
    held = np.zeros(len(names), np.int64)
    for r in found:
        if r["gram"] >= 0:
            held[r["gram"]] = r["n"]
    return held, sum(r["n"] for r in found if r["gram"] < 0)


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])


def match_task(index: Index, threshold: float):
    """Task that aligns every candidate and gives the contaminated pairs."""
    def judge(ids: list, texts: list[bytes]) -> Iterator[tuple]:
        words = Words.of(texts)
        place, entry = index.lookup(words)
        if not len(place):
            return
        doc, item = words.owner[place], index.item[entry]
        where = place - words.first[doc]
        shift = where - index.place[entry]  # where the item would begin
        order = np.lexsort((shift, item, doc))
        doc, item, shift, where = doc[order], item[order], shift[order], where[order]
        length = index.length[item]
        new = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(shift) > np.maximum(4, length[1:] // 3))
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(doc)]])
        best: dict[tuple[int, int], tuple] = {}
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            d, i, n = int(doc[a]), int(item[a]), int(length[a])
            room = max(4, n // 3)
            low = max(0, int(shift[a]) - room)
            text = words.hashes[words.first[d]:words.first[d + 1]]
            points, end = align(index.words.hashes[index.words.first[i]:index.words.first[i + 1]], text[low:int(shift[b - 1]) + n + room])
            if points >= min(n, MIN_MATCHES) and points >= threshold * n and points > best.get((d, i), (0.0,))[0]:
                best[d, i] = (points, points / n, min(int(where[a:b].min()), low + end), low + end)
        for (d, i), (_, score, first, end) in best.items():
            yield ids[d], index.ids[i], score, first, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            if found := [*judge(ids, texts)]:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*found), FOUND)], schema=FOUND)
    return run


def contaminated(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    gram: int = GRAM, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per contaminated pair: ``doc_id``, ``item_id``, ``score``, ``first_word``, ``end_word`` (a word range of the document)."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, first_word long, end_word long")
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block).orderBy("id", "t").collect()  # about BLOCK_BYTES
        index = Index([(r["id"], r["t"]) for r in mine], gram)
        if not len(index.hash):
            continue
        index.keep_rare(*holders(docs, index))
        part = docs.mapInArrow(match_task(index, threshold), "doc_id long, item_id long, score double, first_word long, end_word long")
        out = part if blocks == 1 else out.unionByName(part)
    return out
