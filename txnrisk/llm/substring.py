"""Substring deduplication over windows of words, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document, words being runs of anything but ASCII white space, compared byte by
byte.  A word is removed if a window that covers it has a word sequence that also starts in a document with a smaller ID.
Windows are judged on the input.

Each task packs the windows of its documents as segments (``superkmers``): words joined by one blank, sent to the bucket of their
minimiser.  A bucket sorts the hashes of all its windows, checks equal hashes against the words themselves, and reports the
windows whose smallest ID is below their own document's.  Of a text that a chunk holds several times, only the
smallest document's copies travel: all others are already known to repeat it.

Null texts have no words.  A missing ID counts as larger than any other, so such rows lose what an identified document
has, and nothing to each other.  Rows that repeat an ID are each judged by themselves, against smaller IDs only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import superkmers as S

WINDOW = 13
GRAM = 1
PART_BYTES = 2 << 20  # text of a bucket whose windows are sorted at a time
MAX_BUCKETS = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[S.Piece]:
    """Documents of at least one window as words joined by single blanks; long ones in parts that overlap by a window less one."""
    for b in batches:
        for row, mark, text in zip(b["row_id"].to_pylist(), b["mark"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
            words = text.split()
            step = len(words)
            if len(text) > 2 * S.CHUNK_BYTES:
                step = max(1, len(words) * S.CHUNK_BYTES // len(text))
            for base in range(0, max(0, len(words) - window + 1), max(1, step)):
                part = words[base:base + step + window - 1] if step < len(words) else words
                yield S.Piece(row, mark, base, len(part), b" ".join(part))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of words in text where single blanks or line feeds part them."""
    gaps = np.flatnonzero((data == 32) | (data == 10))
    return np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])


def grams_of(held: list[S.Piece], gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, S.RangeHash, np.ndarray]:
    data = np.frombuffer(b"\n".join(p.data for p in held), np.uint8)
    start, end = word_bounds(data)
    ranges = S.RangeHash(data)
    words = ranges(start, end)
    grams = words[: max(0, len(words) - gram + 1)]
    for k in range(1, gram):
        grams = S.join_hashes(grams, words[k:len(grams) + k])
    return data, start, end, ranges, grams


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hash of every run of ``window`` words from the words' hashes, by doubling."""
    span, whole, out, done = 1, words, None, 0
    while True:
        if window & span:
            out = whole if out is None else S.join_hashes(out[: len(words) - done - span + 1], whole[done:])
            done += span
        if done == window:
            return out
        whole = S.join_hashes(whole[:-span], whole[span:])
        span *= 2


def segment_task(window: int, gram: int, hot: np.ndarray, buckets: int):
    """Task that turns documents into packed segments per bucket, and into spans already known to repeat a smaller document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in S.chunks(pieces(batches, window)):
            data, start, end, ranges, grams = grams_of(held, gram)
            owner = np.repeat(np.arange(len(held)), [p.units for p in held])
            first_unit = np.cumsum([0, *(p.units for p in held)])
            valid = owner[: len(owner) - window + 1] == owner[window - 1:]
            first, last, where = S.runs(grams, hot, window - gram + 1, valid)
            whose = owner[first]
            row, mark, base = (np.array([getattr(p, f) for p in held])[whose] for f in ("row", "mark", "base"))
            a, b = start[first], end[last + window - 1]
            found = S.Segments(
                row.astype(np.int64), mark.astype(np.int32), first - first_unit[whose] + base, last - first + window, where - first,
                grams[where], a, b - a, data,
            )
            yield from send(found, ranges(a, b), buckets, keep_smallest=True)
    return run


def ranked_id(segments: S.Segments) -> np.ndarray:
    """The ID that orders documents; missing ones (odd mark) come last."""
    return np.where(segments.mark & 1, S.LAST, segments.row)


def send(found: S.Segments, hashes: np.ndarray, buckets: int, keep_smallest: bool) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange: blobs per bucket, and spans of segments that need not travel.

    ``keep_smallest``: of equal texts, those of the smallest ID travel and the others are repeats.  Otherwise one travels
    and all of them are repeats.
    """
    order, group = S.local_groups(found, hashes)
    size = np.bincount(group) if len(group) else np.zeros(0, int)
    if keep_smallest:
        ids = ranked_id(found)[order]
        least = np.minimum.reduceat(ids, np.cumsum(size) - size) if len(ids) else ids
        stays = ids > least[group]
        known = order[stays]
    else:
        first = np.concatenate([[True], np.diff(group) != 0]) if len(group) else np.zeros(0, bool)
        stays = ~first
        known = order[size[group] > 1]
    out = [(int(r % buckets), None, r, m, s) for r, m, s in S.merged(found.row[known], found.mark[known], found.start[known], found.start[known] + found.units[known])]
    travels = np.sort(order[~stays])
    target = (S.mix(found.minimiser[travels]) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(target, kind="stable")
    edges = np.flatnonzero(np.diff(target[by])) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(by)]):
        if b > a:
            out.append((int(target[by[a]]), found.take(travels[by[a:b]]).pack(), None, None, None))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), S.SENT)], schema=S.SENT)


def received(table: pa.Table) -> tuple[S.Segments, list[tuple[int, int, bytes]]]:
    """A bucket's segments, and the spans that were only passing through."""
    blobs = [b for b in table["blob"].to_pylist() if b is not None]
    through = table.filter(table["spans"].is_valid())
    return S.Segments.unpack(blobs), list(zip(*(through[c].to_pylist() for c in ("row_id", "mark", "spans"))))


def answer(spans: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = zip(*spans) if spans else ([], [], [])
    return pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, S.FOUND)], schema=S.FOUND)


def judge_windows(segments: S.Segments, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and offset of every window that also starts in a document with a smaller ID.

    A bucket is sorted in parts of about ``PART_BYTES``, dealt by minimiser, so that memory stays at a few arrays over one part.
    """
    parts = max(1, math.ceil(int(segments.size.sum()) / PART_BYTES))
    part = S.mix(segments.minimiser ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    found = [(np.zeros(0, np.int64),) * 2]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b > a:
            owner, offset = judge_part(segments.compact(order[a:b]), window)
            found.append((order[a:b][owner], offset))
    return tuple(np.concatenate(x) for x in zip(*found))


def judge_part(segments: S.Segments, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``judge_windows`` for segments whose texts lie back to back."""
    data = segments.data
    # Blanks part words inside a segment, edges do so between segments, whose texts lie back to back.
    gaps = np.flatnonzero(data == 32)
    start = np.sort(np.concatenate([segments.at, gaps + 1]))
    end = np.sort(np.concatenate([segments.at + segments.size, gaps]))
    ranges = S.RangeHash(data)
    hashes = window_hashes(ranges(start, end), window)
    first_word = np.cumsum(segments.units) - segments.units
    counts = segments.units - window + 1
    at = S.expand(first_word, counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    ids = ranked_id(segments)[owner]
    keys = hashes[at]
    order = np.argsort(keys, kind="stable")
    keys, at, owner, ids = keys[order], at[order], owner[order], ids[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    size = np.diff(np.concatenate([np.flatnonzero(new), [len(keys)]]))
    several = np.repeat(size > 1, size)
    at, owner, ids, new = at[several], owner[several], ids[several], new[several]
    if not len(at):
        return at, at
    group = np.cumsum(new) - 1
    head = at[np.flatnonzero(new)][group]
    # Equal hashes are compared with the first window of their group, word bytes against word bytes.
    length = end[at + window - 1] - start[at]
    equal = length == end[head + window - 1] - start[head]
    for block in np.array_split(np.arange(len(at)), max(1, math.ceil(int(length.sum()) / S.CHUNK_BYTES))):
        use = block[equal[block]]
        same = data[S.expand(start[at[use]], length[use])] == data[S.expand(start[head[use]], length[use])]
        equal[use] = np.logical_and.reduceat(same, np.cumsum(length[use]) - length[use]) if len(use) else True
    if not equal.all():  # a hash collision: those groups are told apart by their words
        for g in np.unique(group[~equal]).tolist():
            members = np.flatnonzero(group == g)
            names: dict[bytes, int] = {}
            for i in members.tolist():
                text = data[start[at[i]]:end[at[i] + window - 1]].tobytes()
                group[i] = names.setdefault(text, group.max() + 1 if names else g)
        order = np.argsort(group, kind="stable")
        at, owner, ids, group = at[order], owner[order], ids[order], np.unique(group[order], return_inverse=True)[1]
    least = np.minimum.reduceat(ids, np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1]))
    repeat = ids > least[group]
    return owner[repeat], at[repeat] - first_word[owner[repeat]]


def repeated_spans(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Packed spans of words to remove, several rows per document row; ``rows`` as ``superkmers.row_keys`` gives them."""
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for held in S.chunks(pieces(batches, window)):
            yield grams_of(held, gram)[4]

    hot, size = S.hot_slots(rows.select("row_id", "mark", "text"), grams)
    buckets = min(MAX_BUCKETS, max(1, math.ceil(3 * size / S.BUCKET_BYTES)))

    def judge(table: pa.Table) -> pa.Table:
        segments, spans = received(table)
        owner, offset = judge_windows(segments, window)
        start = segments.start[owner] + offset
        return answer([*spans, *S.merged(segments.row[owner], segments.mark[owner], start, start + window)])

    sent = rows.select("row_id", "mark", "text").mapInArrow(segment_task(window, gram, hot, buckets), S.SENT_DDL)
    return sent.groupBy("bucket").applyInArrow(judge, S.FOUND_DDL)


def with_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the list of packed spans of each (null: none)."""
    lists = found.groupBy("row_id", "mark").agg(F.collect_list("spans").alias("spans"))
    return rows.join(lists, ["row_id", "mark"], "left")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one blank)."""
    rows = S.row_keys(df, doc_id, text)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, content, packed in zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), b["spans"].to_pylist()):
                words, kept, behind = content.split(), [], 0
                for s, e in zip(*(x.tolist() for x in S.unpack_spans(packed))):
                    kept += words[behind:s]
                    behind = e
                kept += words[behind:]
                out.append((doc, len(words), len(words) - len(kept), b" ".join(kept)))
            columns = [pa.array(list(c)) for c in zip(*out)] if out else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    joined = with_spans(rows, repeated_spans(rows, window))
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
